"""Queries that split, balance or shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harkline.functions.draws import SEED
from harkline.operators import profile, sampling
from harkline.operators.frozen import freeze, freeze_by
from harkline.operators.joins import lookup_join
from harkline.plans import tables as t
from harkline.plans.tables import Query, with_sql

KEY = ["track_id"]


def _bits_sql(salt: str, key: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{SEED}', '{salt}', {key})), 1, 8))::BIGINT"


def _draw_sql(salt: str, key: str) -> str:
    return f"{_bits_sql(salt, key)} / 4294967296.0::DOUBLE"


def binary_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(freeze(t.binary_tracks(spark, sf)), "class", KEY)


def genre_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(freeze(t.genre_tracks(spark, sf)), "class", KEY)


def binary_training(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.training(binary_split(spark, sf))


def triplet_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.random_split(t.active_triplets(spark, sf), ["user_id", "song_id"])


def triplet_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training triplets, and test triplets of users who occur in training."""
    split = freeze(triplet_split(spark, sf))
    train = sampling.training(split)
    return train, sampling.warm_users(sampling.holdout(split), train)


def shuffled_warm_users(spark: SparkSession, sf: str) -> DataFrame:
    """Warm users by the route for lookups too large to broadcast."""
    split = freeze(triplet_split(spark, sf))
    users = sampling.training(split).select("user_id").distinct()
    return lookup_join(sampling.holdout(split), users, "user_id", "left_semi", max_bytes=0, task_rows=20)


def bucketed_warm_users(spark: SparkSession, sf: str, buckets: int | None = None) -> DataFrame:
    """Warm users where the split is stored by user: neither the users of training nor the join move rows again."""
    split = freeze_by(triplet_split(spark, sf), "user_id", buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    users = sampling.training(split).select("user_id").distinct()
    return sampling.holdout(split).join(users.hint("merge"), "user_id", "left_semi")


_RANKED = f"SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_bits_sql('split', 'track_id')}, track_id) AS rn"
SPLIT_SQL = {
    "ranked": f"{_RANKED}, count(*) OVER (PARTITION BY class) AS size FROM binary_tracks",
    "split": "SELECT * EXCLUDE (rn, size), rn < size * 0.8::DOUBLE AS in_train FROM ranked",
    "training": "SELECT * EXCLUDE (in_train) FROM split WHERE in_train",
}
SPLIT_MULTI_SQL = SPLIT_SQL | {"ranked": f"{_RANKED}, count(*) OVER (PARTITION BY class) AS size FROM genre_tracks"}

_DOWN = """SELECT {columns} FROM training WHERE class <> 0 OR
    {draw} < (SELECT 3.0::DOUBLE * count(*) FILTER (class = 1) / (count(*) FILTER (class = 0))::DOUBLE FROM training)"""
_COPIES = " + ".join(
    f"CASE WHEN {_draw_sql('up', f'track_id, {chr(39)}{i}{chr(39)}')} > 0.75::DOUBLE THEN 1 ELSE 0 END" for i in range(1, 11)
)

QUERIES = {
    "class_row_number": Query(
        lambda spark, sf: sampling.class_row_number(
            t.binary_tracks(spark, sf).select("track_id", "class"), "class", KEY
        ),
        with_sql(f"""SELECT track_id, class, row_number() OVER (PARTITION BY class
            ORDER BY {_bits_sql('split', 'track_id')}, track_id) AS row FROM binary_tracks"""),
    ),
    "stratified_split": Query(
        lambda spark, sf: binary_split(spark, sf).select("track_id", "class", "in_train"),
        with_sql("SELECT track_id, class, in_train FROM split", **SPLIT_SQL),
    ),
    "stratified_split_multi": Query(
        lambda spark, sf: genre_split(spark, sf).select("track_id", "class", "in_train"),
        with_sql("SELECT track_id, class, in_train FROM split", **SPLIT_MULTI_SQL),
    ),
    "holdout_complement": Query(
        lambda spark, sf: sampling.holdout(binary_split(spark, sf)).select("track_id", "class"),
        with_sql("SELECT track_id, class FROM split WHERE NOT in_train", **SPLIT_SQL),
    ),
    "downsample": Query(
        lambda spark, sf: sampling.downsample(freeze(binary_training(spark, sf)), "class", KEY).select("track_id", "class"),
        with_sql(_DOWN.format(columns="track_id, class", draw=_draw_sql("down", "track_id")), **SPLIT_SQL),
    ),
    "upsample": Query(
        lambda spark, sf: sampling.upsample(binary_training(spark, sf), "class", KEY).select("track_id", "class"),
        with_sql(f"""SELECT track_id, class FROM (SELECT track_id, class,
            unnest(range(CASE WHEN class = 1 THEN {_COPIES} ELSE 1 END)) AS copy FROM training)""", **SPLIT_SQL),
    ),
    "class_weight": Query(
        lambda spark, sf: sampling.class_weight(binary_training(spark, sf), "class").select("track_id", "class", "weight"),
        with_sql("""SELECT track_id, class, CASE WHEN class = 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
            FROM training""", **SPLIT_SQL),
    ),
    "weighted_balance": Query(
        lambda spark, sf: profile.class_balance(
            sampling.class_weight(binary_training(spark, sf), "class"), weight="weight"
        ),
        with_sql("""SELECT class, count(*) AS count, sum(weight) AS weight,
            round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 3) AS ratio,
            round(sum(weight) / sum(sum(weight)) OVER (), 3) AS weight_ratio FROM (
                SELECT class, CASE WHEN class = 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM training)
            GROUP BY class""", **SPLIT_SQL),
    ),
    "triplet_split": Query(
        triplet_split,
        with_sql("SELECT user_id, song_id, play_count, bits / 4294967296.0::DOUBLE < 0.7::DOUBLE AS in_train FROM drawn"),
    ),
    "split_report": Query(
        lambda spark, sf: sampling.split_report(freeze(triplet_split(spark, sf))),
        with_sql("""SELECT 'training' AS part, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM train
            UNION ALL SELECT 'holdout', count(*), count(DISTINCT user_id) FROM held_out
            UNION ALL SELECT 'warm', count(*), count(DISTINCT user_id) FROM test
            UNION ALL SELECT 'scorable', count(*), count(DISTINCT user_id) FROM test WHERE song_id IN (SELECT song_id FROM train)
            UNION ALL SELECT 'unseen_songs', count(*), count(DISTINCT user_id) FROM test
                WHERE song_id NOT IN (SELECT song_id FROM train)"""),
    ),
    "warm_users_shuffled": Query(
        lambda spark, sf: shuffled_warm_users(spark, sf),
        with_sql("SELECT * FROM test"),
    ),
    "warm_users_bucketed": Query(bucketed_warm_users, with_sql("SELECT * FROM test")),
    "warm_users": Query(lambda spark, sf: triplet_sides(spark, sf)[1], with_sql("SELECT * FROM test")),
    "shuffled": Query(
        lambda spark, sf: sampling.shuffled(t.active_triplets(spark, sf), ["user_id", "song_id"]),
        with_sql(f"""SELECT *, row_number() OVER (ORDER BY {_bits_sql('shuffle', 'user_id, song_id')}, user_id, song_id) AS place
            FROM active"""),
    ),
}
