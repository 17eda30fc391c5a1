"""Writing an intermediate result down."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from harkline.session import BUCKETED, tables_dir


def freeze(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared scratch folder.

    Used where several jobs read one result, or where a value must not change
    when a lost task is run again (partition numbers, model inputs). It cuts the
    lineage, survives the loss of executors, and gives the optimizer a measured
    size.
    """
    path = f"{tables_dir(df.sparkSession)}/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freeze_by(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared scratch folder, in ``buckets`` by ``key``.

    Rows are shuffled once, for this. Later groupings by the key, and joins on it with tables of as many buckets, do not
    move them again. The session's catalog names the table until ``session.release_tables``.
    """
    spark, name = df.sparkSession, f"harkline_{uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{tables_dir(spark)}/{name}").saveAsTable(name)
    BUCKETED.append(name)
    return spark.table(name)
