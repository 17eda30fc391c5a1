"""Feature tables whose columns are described by a companion attribute file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from harkline.sources.text import read_delimited

# Fixed values of the input format: type words that mean a number, case-sensitive.
NUMBER_WORDS = ["NUMERIC", "real"]


def attribute_columns(spark: SparkSession, path: str) -> DataFrame:
    """``(position, name, type)`` of each ``name,type word`` line; blank lines are skipped.

    The file is read as one text, since separate lines carry no position. It lists
    the columns of one table, so it is small by nature.
    """
    line = F.col("line")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(F.split("value", "\r?\n")).alias("position", "line"))
        .filter(F.trim(line) != "")
        .select(
            "position",
            F.trim(F.split_part(line, F.lit(","), F.lit(1))).alias("name"),
            F.when(F.trim(F.split_part(line, F.lit(","), F.lit(2))).isin(NUMBER_WORDS), "double")
            .otherwise("string")
            .alias("type"),
        )
    )


def attribute_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema an attribute file describes."""
    schema = T.StructType()
    for column in attribute_columns(spark, path).orderBy("position").collect():
        schema.add(column["name"], column["type"], True)
    return schema


def load_features(spark: SparkSession, root: str, name: str, partitions: int | None = None) -> DataFrame:
    """The feature set ``<root>/features/<name>.csv`` typed by ``<root>/attributes/<name>.attributes.csv``."""
    schema = attribute_schema(spark, f"{root}/attributes/{name}.attributes.csv")
    return read_delimited(spark, f"{root}/features/{name}.csv", schema=schema, partitions=partitions)


def save_features(df: DataFrame, root: str, name: str) -> None:
    """Writes a feature table in the layout ``load_features`` reads: gzip parts and an attribute file."""
    df.write.option("compression", "gzip").csv(f"{root}/features/{name}.csv")
    words = [f"{f.name},{'NUMERIC' if f.dataType == T.DoubleType() else 'STRING'}" for f in df.schema]
    lines = df.sparkSession.createDataFrame([("\n".join(words),)], "value string")
    lines.coalesce(1).write.text(f"{root}/attributes/{name}.attributes.csv")
