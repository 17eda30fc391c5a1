"""The supplied tables, and the music tables derived from them.

Every derived table has a Spark form and a SQL form. An order line is a play: the
customer is the user, the part is the song (and track), the quantity is the
number of plays; a brand is a genre.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harkline.operators import clean, features
from harkline.operators.frozen import freeze
from harkline.operators.joins import lookup_join
from harkline.sources.text import parse_mismatches

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Settings of the derived data, used alike in both forms.
MIN_PLAYS = 600
MIN_SONGS = 30
POSITIVE_GENRE = "Brand#4"
MISMATCHED_SIZE = 2  # parts up to this size are on the mismatch list
FEATURES = ["n", "sq", "aq", "sd", "sp", "ap", "ad"]


@dataclass(frozen=True)
class Query:
    """A query over the supplied tables and, where there is one, its SQL twin."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _code(letter: str, key: str) -> Column:
    return F.concat(F.lit(letter), F.lpad(F.col(key).cast("string"), 17, "0"))


def _code_sql(letter: str, key: str) -> str:
    return f"'{letter}' || lpad(CAST({key} AS VARCHAR), 17, '0')"


def triplets(spark: SparkSession, sf: str) -> DataFrame:
    """``(user_id, song_id, play_count)``, one row per pair."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        lookup_join(lines, orders, "l_orderkey", "inner", stored=True, facts_stored=True)
        .groupBy("o_custkey", "l_partkey")
        .agg(F.sum("l_quantity").cast("int").alias("play_count"))
        .select(_code("U", "o_custkey").alias("user_id"), _code("S", "l_partkey").alias("song_id"), "play_count")
    )


def mismatch_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-width lines: song id from character 9, track id from character 28."""
    part = table(spark, sf, "part").filter(F.col("p_size") <= MISMATCHED_SIZE)
    song, track = _code("S", "p_partkey"), _code("T", "p_partkey")
    return part.select(F.concat(F.lit("ERROR: <"), song, F.lit(" "), track, F.lit("> "), F.col("p_name")).alias("value"))


def mismatches(spark: SparkSession, sf: str) -> DataFrame:
    return parse_mismatches(mismatch_lines(spark, sf))


def clean_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_mismatched(triplets(spark, sf), mismatches(spark, sf))


def stored_triplets(spark: SparkSession, sf: str) -> DataFrame:
    """Clean triplets as a table, for queries that read them more than once."""
    return freeze(clean_triplets(spark, sf))


def active_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return clean.active_subset(stored_triplets(spark, sf), MIN_PLAYS, MIN_SONGS)


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """A quoted track id and seven numbers about the plays of each track."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(quantity).alias("sq"),
            F.round(F.avg(quantity), 10).alias("aq"),
            F.round(F.coalesce(F.stddev(quantity), F.lit(0.0)), 6).alias("sd"),
            F.round(F.sum(price), 2).alias("sp"),
            F.round(F.round(F.sum(price), 2) / F.count(F.lit(1)), 8).alias("ap"),
            F.round(F.avg("l_discount"), 10).alias("ad"),
        )
        .select(F.concat(F.lit("'"), _code("T", "l_partkey"), F.lit("'")).alias("MSD_TRACKID"), *FEATURES)
    )


def genres(spark: SparkSession, sf: str) -> DataFrame:
    return genres_of(table(spark, sf, "part"))


def genres_of(parts: DataFrame) -> DataFrame:
    return parts.select(_code("T", "p_partkey").alias("track_id"), F.col("p_brand").alias("genre"))


def labelled_features(spark: SparkSession, sf: str) -> DataFrame:
    """``(track_id, genre, *FEATURES)`` of the tracks with a genre."""
    return clean.label_features(genres(spark, sf), clean.normalize_track_id(feature_table(spark, sf)))


def binary_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled features with class 1 for one genre."""
    return features.binary_label(labelled_features(spark, sf), POSITIVE_GENRE)


def genre_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled features with a class per genre."""
    tracks = freeze(labelled_features(spark, sf))
    indexed = features.apply_index(tracks, freeze(features.frequency_index(tracks, "genre", "class")), "genre")
    return indexed.select(*tracks.columns, "class")


_SQL_PARTS = {
    "triplets": f"""
        SELECT {_code_sql('U', 'o_custkey')} AS user_id, {_code_sql('S', 'l_partkey')} AS song_id,
               CAST(sum(l_quantity) AS INTEGER) AS play_count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey""",
    "mismatch_lines": f"""
        SELECT 'ERROR: <' || {_code_sql('S', 'p_partkey')} || ' ' || {_code_sql('T', 'p_partkey')} || '> ' || p_name AS value
        FROM part WHERE p_size <= {MISMATCHED_SIZE}""",
    "mismatches": "SELECT substr(value, 9, 18) AS song_id, substr(value, 28, 18) AS track_id FROM mismatch_lines",
    "clean_triplets": "SELECT * FROM triplets WHERE song_id NOT IN (SELECT song_id FROM mismatches)",
    "low_plays": f"""
        SELECT song_id, CAST(sum(play_count) AS BIGINT) AS total_plays FROM clean_triplets
        GROUP BY song_id HAVING sum(play_count) < {MIN_PLAYS}""",
    "low_songs": f"""
        SELECT user_id, count(*) AS n_songs FROM clean_triplets GROUP BY user_id HAVING count(*) < {MIN_SONGS}""",
    "played": "SELECT * FROM clean_triplets WHERE song_id NOT IN (SELECT song_id FROM low_plays)",
    "active": "SELECT * FROM played WHERE user_id NOT IN (SELECT user_id FROM low_songs)",
    "drawn": """
        SELECT *, ('0x' || substr(md5(concat_ws(':', '42', 'triplet', user_id, song_id)), 1, 8))::BIGINT AS bits FROM active""",
    "train": "SELECT user_id, song_id, play_count FROM drawn WHERE bits / 4294967296.0::DOUBLE < 0.7::DOUBLE",
    "held_out": "SELECT user_id, song_id, play_count FROM drawn WHERE NOT bits / 4294967296.0::DOUBLE < 0.7::DOUBLE",
    "test": "SELECT * FROM held_out WHERE user_id IN (SELECT user_id FROM train)",
    "features": f"""
        SELECT '''' || {_code_sql('T', 'l_partkey')} || '''' AS "MSD_TRACKID",
               CAST(count(*) AS DOUBLE) AS n, sum(l_quantity) AS sq, round(avg(l_quantity), 10) AS aq,
               round(coalesce(stddev_samp(l_quantity), 0), 6) AS sd, round(sum(l_extendedprice), 2) AS sp,
               round(round(sum(l_extendedprice), 2) / count(*), 8) AS ap, round(avg(l_discount), 10) AS ad
        FROM lineitem GROUP BY l_partkey""",
    "plain_features": """
        SELECT substr("MSD_TRACKID", 2, 18) AS track_id, * EXCLUDE ("MSD_TRACKID") FROM features""",
    "genres": f"""
        SELECT {_code_sql('T', 'p_partkey')} AS track_id, p_brand AS genre FROM part""",
    "labelled": "SELECT g.track_id, g.genre, f.* EXCLUDE (track_id) FROM genres g JOIN plain_features f USING (track_id)",
    "binary_tracks": f"""
        SELECT *, CASE WHEN genre = '{POSITIVE_GENRE}' THEN 1 ELSE 0 END AS class FROM labelled""",
    "genre_index": """
        SELECT genre, CAST(row_number() OVER (ORDER BY count(*) DESC, genre) - 1 AS INTEGER) AS class
        FROM labelled GROUP BY genre""",
    "genre_tracks": "SELECT l.*, i.class FROM labelled l JOIN genre_index i USING (genre)",
}


def with_sql(body: str, **more: str) -> str:
    """``body`` preceded by the derived tables it reads, in order of their definition.

    ``more`` are tables of the body's own.
    """
    parts = _SQL_PARTS | more
    needed: set[str] = set()

    def need(text: str) -> None:
        for name, definition in parts.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                need(definition)

    need(body)
    listed = [f"{name} AS ({definition})" for name, definition in parts.items() if name in needed]
    return f"WITH {', '.join(listed)} {body}" if listed else body
