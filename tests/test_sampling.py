"""Properties of splits and re-balancing."""

from math import ceil, sqrt

import pytest
from pyspark.sql import functions as F

from harkline.functions.draws import draw, draw_bits
from harkline.operators.frozen import freeze
from harkline.operators import sampling

SIZES = {0: 4000, 1: 2500, 2: 301, 3: 7, 4: 1}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"T{c}-{i}", c) for c, n in SIZES.items() for i in range(n)] + [("nolabel", None)]
    return spark.createDataFrame(data, "track_id string, class int").repartition(5)


@pytest.mark.parametrize("fraction", [0.8, 0.5, 0.01, 1.0])
def test_split_sizes_and_ranks(rows, fraction):
    split = sampling.stratified_split(rows, "class", ["track_id"], fraction)
    assert split.columns == ["track_id", "class", "in_train"]
    assert split.count() == rows.count()
    train = {r["track_id"] for r in sampling.training(split).collect()}
    ranked = sampling.class_row_number(rows, "class", ["track_id"]).collect()
    expected = {r["track_id"] for r in ranked if r["class"] is not None and r["row"] < SIZES[r["class"]] * fraction}
    assert train == expected
    for c, n in SIZES.items():
        assert sum(r["class"] == c and r["track_id"] in train for r in ranked) == ceil(n * fraction) - 1
        assert sorted(r["row"] for r in ranked if r["class"] == c) == list(range(1, n + 1))


def test_sides_are_complements(rows):
    split = sampling.stratified_split(rows, "class", ["track_id"])
    train, test = sampling.training(split), sampling.holdout(split)
    assert train.join(test, "track_id").count() == 0
    assert train.count() + test.count() == rows.count()
    assert sorted(test.collect()) == sorted(sampling.holdout_of_tables(rows, train, "track_id").select(test.columns).collect())


def test_split_does_not_move_rows(rows):
    plan = sampling.stratified_split(rows, "class", ["track_id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "hashpartitioning" not in plan


def test_rows_that_share_a_key_stay_together(spark):
    data = [(f"k{i % 50}", 0) for i in range(1000)] + [("hot", 0)] * 500
    split = sampling.stratified_split(spark.createDataFrame(data, "key string, class int"), "class", ["key"])
    assert split.groupBy("key").agg(F.countDistinct("in_train").alias("sides")).filter("sides > 1").count() == 0
    assert sampling.training(split).count() < 1500 * 0.8


def test_many_keys_in_one_draw_range(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RANGE_BITS", 31)
    df = spark.range(900).selectExpr("cast(id as string) AS track_id", "cast(id % 2 as int) AS class")
    split = sampling.stratified_split(df, "class", ["track_id"])
    ranked = sampling.class_row_number(df, "class", ["track_id"]).filter(F.col("row") < 450 * 0.8)
    assert sorted(r["track_id"] for r in sampling.training(split).collect()) == sorted(r["track_id"] for r in ranked.collect())


def test_draws_are_uniform_and_independent(spark):
    draws = {"a": draw(["id"], "a"), "b": draw(["id"], "b"), "bits": draw_bits(["id"], "a")}
    df = spark.range(20_000).withColumns(draws)
    row = df.agg(F.avg("a"), F.corr("a", "b"), F.min("bits"), F.max("bits")).head()
    assert abs(row[0] - 0.5) < 0.01 and abs(row[1]) < 0.03
    assert 0 <= row[2] < row[3] < 2**32


def test_downsample_ratio(spark):
    df = spark.range(20_000).selectExpr("id", "IF(id < 1000, 1, 0) AS class")
    kept = {r["class"]: r["count"] for r in sampling.downsample(df, "class", ["id"]).groupBy("class").count().collect()}
    assert kept[1] == 1000
    assert abs(kept[0] - 3000) < 4 * sqrt(3000)


def test_upsample_copies(spark):
    df = spark.range(4000).selectExpr("id", "IF(id < 2000, 1, 0) AS class")
    copies = sampling.upsample(df, "class", ["id"]).groupBy("class").count().collect()
    counts = {r["class"]: r["count"] for r in copies}
    assert counts[0] == 2000
    assert abs(counts[1] - 2000 * 2.5) < 3 * sqrt(2000 * 10 * 0.25 * 0.75)
    per_row = sampling.upsample(df, "class", ["id"], min_copies=1).groupBy("id").count()
    per_row = per_row.agg(F.min("count"), F.max("count"), F.count("*")).head()
    assert per_row[0] == 1 and per_row[1] <= 10 and per_row[2] == 4000


def test_random_split_and_warm_users(spark):
    df = spark.range(10_000).selectExpr("concat('u', id % 3000) AS user_id", "concat('s', id) AS song_id", "1 AS play_count")
    split = sampling.random_split(df, ["user_id", "song_id"])
    train, test = sampling.training(split), sampling.holdout(split)
    assert abs(train.count() - 7000) < 200
    warm = sampling.warm_users(test, train)
    known = {r["user_id"] for r in train.collect()}
    assert sorted(warm.collect()) == sorted(r for r in test.collect() if r["user_id"] in known)
    assert warm.count() < test.count()


def test_shuffle_is_a_permutation(spark):
    out = sampling.shuffled(spark.range(500), ["id"]).collect()
    assert sorted(r["place"] for r in out) == list(range(1, 501))
    ids = [r["id"] for r in sorted(out, key=lambda r: r["place"])]
    assert sorted(ids) == list(range(500)) and ids != list(range(500))


def test_warm_users_of_a_table_are_not_written_down_again(spark, monkeypatch):
    from harkline.operators import joins

    rows = freeze(spark.createDataFrame([("a", "x", True), ("a", "y", False), ("b", "z", False), (None, "x", False)], "user_id string, song_id string, in_train boolean"))
    written = []
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "freeze", lambda df: written.append(df.columns) or freeze(df))
    warm = sampling.warm_users(sampling.holdout(rows), sampling.training(rows), stored=True)
    assert [r["song_id"] for r in warm.collect()] == ["y"]
    assert ["user_id", "song_id"] not in written
