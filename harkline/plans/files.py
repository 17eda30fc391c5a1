"""Queries that read row text: the derived tables are written as such files and read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.plans import tables as t
from harkline.plans.tables import Query, with_sql
from harkline.session import tables_dir
from harkline.sources import attributes, text


# All columns of ``lineitem`` but the time, which both engines write out alike.
_LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
)


def _new_folder(spark: SparkSession) -> str:
    return f"{tables_dir(spark)}/{uuid4().hex}"


def feature_files(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table from gzip CSV parts, typed by its attribute file."""
    folder = _new_folder(spark)
    attributes.save_features(t.feature_table(spark, sf), folder, "plays-v1.0")
    return attributes.load_features(spark, folder, "plays-v1.0")


def untyped_files(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines from files without a header or schema: every column, as the strings that lie there."""
    folder = _new_folder(spark)
    t.table(spark, sf, "lineitem").select(*_LINE_COLUMNS).write.option("compression", "gzip").csv(folder)
    return text.read_delimited(spark, folder)


def triplet_files(spark: SparkSession, sf: str) -> DataFrame:
    """Triplets from gzip TSV parts."""
    folder = _new_folder(spark)
    t.triplets(spark, sf).write.option("sep", "\t").option("compression", "gzip").csv(folder)
    return text.read_triplets(spark, folder)


def genre_files(spark: SparkSession, sf: str) -> DataFrame:
    """Genre labels from TSV."""
    folder = _new_folder(spark)
    t.genres(spark, sf).write.option("sep", "\t").csv(folder)
    return text.read_genres(spark, folder)


def header_files(spark: SparkSession, sf: str) -> DataFrame:
    """Part descriptions from gzip CSV with a header."""
    folder = _new_folder(spark)
    parts = t.table(spark, sf, "part")
    parts.write.option("header", True).option("compression", "gzip").csv(folder)
    return text.read_delimited(spark, folder, header=True)


def mismatch_files(spark: SparkSession, sf: str) -> DataFrame:
    """Mismatches from fixed-width text."""
    folder = _new_folder(spark)
    t.mismatch_lines(spark, sf).write.text(folder)
    return text.parse_mismatches(text.read_lines(spark, folder))


def quarantined_triplets(spark: SparkSession, sf: str) -> DataFrame:
    """Triplets from TSV parts, of which some have lost their last field, got another, or have a word for a number: rows and plays
    that are read, and rows put aside by reason."""
    folder = _new_folder(spark)
    plays = F.col("play_count")
    last = F.when(plays % 5 == 0, "").when(plays % 7 == 0, F.concat(F.lit("\tx"), plays)).when(plays % 11 == 0, F.concat(F.lit("\t"), plays, F.lit("\t0"))).otherwise(F.concat(F.lit("\t"), plays))
    t.triplets(spark, sf).select(F.concat("user_id", F.lit("\t"), "song_id", last).alias("value")).write.text(folder)
    good, bad = text.read_checked(spark, folder, text.TRIPLET_SCHEMA, sep="\t")
    read = good.agg(F.lit("read").alias("reason"), F.count(F.lit(1)).alias("n_rows"), F.sum("play_count").alias("plays"))
    aside = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("long").alias("plays"))
    return read.unionByName(aside)


QUERIES = {
    "quarantined_triplets": Query(
        quarantined_triplets,
        with_sql(
            """SELECT CASE WHEN play_count % 5 = 0 THEN 'fields' WHEN play_count % 7 = 0 THEN 'types' WHEN play_count % 11 = 0 THEN 'fields' ELSE 'read' END AS reason,
                count(*) AS n_rows, CAST(sum(CASE WHEN play_count % 5 <> 0 AND play_count % 7 <> 0 AND play_count % 11 <> 0 THEN play_count END) AS BIGINT) AS plays
                FROM triplets GROUP BY reason"""
        ),
    ),
    "feature_files": Query(feature_files, with_sql("SELECT * FROM features")),
    "untyped_files": Query(
        untyped_files,
        f"""SELECT {', '.join(f'CAST({c} AS VARCHAR) AS _c{i}' for i, c in enumerate(_LINE_COLUMNS))} FROM lineitem""",
    ),
    "triplet_files": Query(triplet_files, with_sql("SELECT * FROM triplets")),
    "genre_files": Query(genre_files, with_sql("SELECT * FROM genres")),
    "header_files": Query(
        header_files, "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM part"
    ),
    "mismatch_files": Query(mismatch_files, with_sql("SELECT * FROM mismatches")),
}
