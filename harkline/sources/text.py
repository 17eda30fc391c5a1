"""Reading row text: CSV, TSV and fixed-width lines, plain or compressed.

A path may name a file or a directory of part files; Spark picks the codec from
the file extension. A gzip part cannot be split, so a scan has as many tasks as
there are parts. ``partitions`` spreads the rows after such a scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from harkline.functions import ids
from harkline.operators.frozen import freeze

TRIPLET_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("play_count", T.IntegerType()),
    ]
)
GENRE_SCHEMA = T.StructType([T.StructField("track_id", T.StringType()), T.StructField("genre", T.StringType())])


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = False,
    schema: T.StructType | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Delimited text. Without a schema every column is a string, never inferred."""
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df if partitions is None else df.repartition(partitions)


_RAW = "_raw"


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows of delimited text that fit ``schema``, and ``(file, line, reason)`` of those that do not.

    A row with more or fewer fields is refused as ``fields``, one with a value that is not of its column's type as ``types``. Empty values are
    nulls and fit. The files are parsed once and the result written down, so no row is in both frames or in neither.
    """
    whole = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
    rows = reader.schema(whole).csv(path)
    n = F.size(F.split(F.col(_RAW), f"\\Q{sep}\\E", -1))
    reason = F.when(n == len(schema), "types").otherwise("fields")
    judged = freeze(rows.select("*", F.input_file_name().alias("_file")))
    bad = judged.filter(F.col(_RAW).isNotNull()).select(F.col("_file").alias("file"), F.col(_RAW).alias("line"), reason.alias("reason"))
    return judged.filter(F.col(_RAW).isNull()).select(*schema.names), bad


def read_triplets(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    return read_delimited(spark, path, sep="\t", schema=TRIPLET_SCHEMA, partitions=partitions)


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, sep="\t", schema=GENRE_SCHEMA)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text, one ``value`` per line."""
    return spark.read.text(path)


def parse_mismatches(lines: DataFrame) -> DataFrame:
    """Song and track ids of fixed-width mismatch lines."""
    value = F.col("value")
    return lines.select(ids.mismatch_song(value).alias("song_id"), ids.mismatch_track(value).alias("track_id"))
