"""Joins, ranks and totals where one key holds a third of the rows, against brute force."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from harkline.operators import clean, joins, profile, ranking, running
from harkline.operators.frozen import freeze
from harkline.operators.joins import lookup_join
from harkline.operators.running import rank_within, running_total
from harkline.plans import models
from harkline.session import release_tables


def skewed_rows(n=6000, keys=40, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        draw = rng.random()
        key = "hot" if draw < 0.35 else None if draw < 0.5 else f"k{rng.randrange(keys)}"
        rows.append((i, key, rng.randrange(50)))
    return rows


@pytest.fixture(scope="module", autouse=True)
def several_partitions(spark):
    """Keeps Spark from merging the small partitions, so that groups do spread over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(skewed_rows(), "id int, key string, v int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_bytes", [None, 0])
def test_lookup_join_equals_plain_join(spark, facts, how, max_bytes):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("absent", 4)], "key string, w int")
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select("key")
    ours = lookup_join(facts, lookup, "key", how, max_bytes=max_bytes)
    plain = facts.join(lookup, "key", how)
    assert ours.columns == plain.columns
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))


def test_keys_to_spread_are_found(spark, facts):
    expected = facts.groupBy("key").count().filter("count > 300").select(F.xxhash64("key"), F.ceil(F.col("count") / 300)).collect()
    assert sorted(joins.spread_keys(facts, ["key"], 300).collect()) == sorted(expected) and expected
    assert joins.spread_keys(facts.limit(0), ["key"], 300).count() == 0


@pytest.mark.parametrize("task_rows", [1, 100, 10**9])
def test_spreading_matters_for_speed_only(spark, facts, task_rows):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, w int")
    ours = lookup_join(facts, lookup, "key", "inner", max_bytes=0, task_rows=task_rows)
    assert sorted(ours.collect()) == sorted(facts.join(lookup, "key").collect())


def test_large_lookup_spreads_the_hot_key(spark, facts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lookup = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, w int")
        joined = lookup_join(facts, lookup, "key", "inner", max_bytes=0, task_rows=500).filter("key = 'hot'")
        assert joined.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_equal_rows_of_one_key_use_all_salts(spark):
    facts = freeze(spark.range(3000).select(F.lit("hot").alias("key")))
    lookup = spark.createDataFrame([("hot", 1)], "key string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        joined = lookup_join(facts, lookup, "key", "inner", max_bytes=0, task_rows=100, facts_stored=True)
        parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    # Thirty salts of a hundred rows each, by hash over 64 partitions.
    assert sum(parts) == 3000 and len(parts) > 15 and max(parts) <= 600


NUMBERS = [1.0, 1.5, 2.0, 2.0**40, None]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("types", [("int", "double"), ("double", "int"), ("int", "bigint"), ("bigint", "int"), ("int", "decimal(9,2)"), ("decimal(5,1)", "decimal(20,4)")])
def test_lookup_key_of_another_number_type(spark, types, how):
    def fits(kind):
        return [x for x in NUMBERS if x is None or ((x < 2**31 or kind in ("double", "bigint", "decimal(20,4)")) and (x % 1 == 0 or "int" not in kind))]

    facts = spark.createDataFrame([(x,) for x in fits(types[0]) * 3], "key double").select(F.col("key").cast(types[0]))
    lookup = spark.createDataFrame([(x, "w") for x in fits(types[1])], "key double, w string").select(F.col("key").cast(types[1]), "w")
    plain = facts.join(lookup, "key", how)
    for max_bytes in (None, 0):
        ours = lookup_join(facts, lookup, "key", how, max_bytes=max_bytes, task_rows=1)
        assert ours.schema["key"].dataType == facts.schema["key"].dataType
        key = lambda df: sorted((repr(None if r["key"] is None else float(r["key"])), *r[1:]) for r in df.collect())
        assert [repr(r) for r in key(ours)] == [repr(r) for r in key(plain)]


def test_lookup_keys_that_do_not_compare_are_refused(spark):
    facts, lookup = spark.createDataFrame([("01", 1)], "key string, v int"), spark.createDataFrame([(1, 2)], "key int, w int")
    for max_bytes in (None, 0):
        with pytest.raises(TypeError, match="cast one first"):
            lookup_join(facts, lookup, "key", "inner", max_bytes=max_bytes)


def test_facts_with_a_map_column(spark):
    facts = spark.createDataFrame([(i % 3, {"a": i}, [{"b": i}]) for i in range(30)], "key int, m map<string,int>, l array<map<string,int>>")
    lookup = spark.createDataFrame([(0, "x"), (1, "y")], "key int, w string")
    for max_bytes in (None, 0):
        ours = lookup_join(facts, lookup, "key", "left", max_bytes=max_bytes, task_rows=2)
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, facts.join(lookup, "key", "left").collect()))


def test_lookup_size_is_in_bytes(spark):
    long = spark.createDataFrame([(1, "x" * 1000, [1] * 500), (2, None, None)], "key int, t string, a array<int>")
    assert 2000 < joins.stored_bytes(long) < 3000 and joins.stored_bytes(long.limit(0)) == 0


def test_lookup_join_on_two_keys(spark, facts):
    lookup = facts.filter("id % 3 = 0").select("id", "key", F.lit(1).alias("w"))
    for max_bytes in (None, 0):
        ours = lookup_join(facts, lookup, ["id", "key"], "inner", max_bytes=max_bytes)
        assert sorted(ours.collect()) == sorted(facts.join(lookup, ["id", "key"]).collect())


@pytest.mark.parametrize("within", [(), ("key",)])
@pytest.mark.parametrize("part_bits", [running.PART_BITS, 5])
def test_running_total(facts, within, part_bits, monkeypatch):
    monkeypatch.setattr(running, "PART_BITS", part_bits)
    order = [F.desc("v"), F.asc("id")]
    got = running_total(facts, {"rows": F.lit(1), "total": F.col("v")}, order, within)
    assert got.columns == ["id", "key", "v", "rows", "total"]
    expected = {}
    groups = {}
    for row in skewed_rows():
        groups.setdefault(row[1] if within else "", []).append(row)
    for rows in groups.values():
        rows.sort(key=lambda r: (-r[2], r[0]))
        for place, (row, total) in enumerate(zip(rows, accumulate(r[2] for r in rows)), 1):
            expected[row[0]] = (place, total)
    assert {r["id"]: (r["rows"], r["total"]) for r in got.collect()} == expected


def test_a_hot_group_is_ranked_by_many_tasks(facts):
    hot = facts.filter("key = 'hot'")
    ranked = rank_within(hot, "place", [F.asc("id")], ["key"])
    assert len(ranked.groupBy(F.spark_partition_id()).count().collect()) > 1
    assert ranked.agg(F.max("place")).head()[0] == hot.count()


def test_rankings_of_a_hot_user(facts):
    rows = skewed_rows()
    expected = {}
    for user in {r[1] for r in rows}:
        for place, row in enumerate(sorted((r for r in rows if r[1] == user), key=lambda r: (-r[2], r[0])), 1):
            expected[user, place] = row[0]
    whole = ranking.ranked_items(facts, "key", "id", "v")
    assert {(r["key"], r["position"]): r["id"] for r in whole.collect()} == expected
    top = ranking.top_k_items(facts, "key", "id", "v", 7)
    assert {(r["key"], r["position"]): r["id"] for r in top.collect()} == {k: v for k, v in expected.items() if k[1] <= 7}


def test_exact_percentiles(facts):
    values = sorted(r[2] for r in skewed_rows())
    shares = [0.0, 0.1, 0.333, 0.5, 0.99, 1.0]
    got = {r["share"]: r["value"] for r in profile.exact_percentiles(facts, "v", shares).collect()}
    for share in shares:
        place = share * (len(values) - 1)
        low = int(place)
        high = min(low + 1, len(values) - 1)
        assert got[share] == pytest.approx(values[low] + (values[high] - values[low]) * (place - low))


def test_density_is_a_density(facts):
    points = sorted((r["x"], r["density"]) for r in profile.density(facts, "v", 400).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(1.0, abs=1e-3)


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(5,), (5,), (None,)], "v int")
    assert [tuple(r) for r in profile.histogram(df, "v", 4).collect()] == [(1, 5.0, 5.0, 2)]


def test_activity_options(spark):
    triplets = spark.createDataFrame(
        [("u1", "s1", 5), ("u1", "s1", 6), ("u1", "s2", 1), ("u2", "s1", 9)], "user_id string, song_id string, play_count int"
    )
    assert [r["user_id"] for r in clean.low_song_users(triplets, 3).collect()] == ["u2"]
    assert sorted(r["user_id"] for r in clean.low_song_users(triplets, 3, distinct_songs=True).collect()) == ["u1", "u2"]
    assert sorted(r["song_id"] for r in clean.active_subset(triplets, 10, 3).collect()) == ["s1", "s1"]


def test_accepted_pairs_are_taken_off_the_list(spark):
    triplets = spark.createDataFrame([("u", "s1", 1), ("u", "s2", 1)], "user_id string, song_id string, play_count int")
    listed = spark.createDataFrame([("s1", "t1"), ("s2", "t2")], "song_id string, track_id string")
    assert clean.drop_mismatched(triplets, listed).count() == 0
    kept = clean.drop_mismatched(triplets, listed, accepted=listed.filter("song_id = 's1'"))
    assert [r["song_id"] for r in kept.collect()] == ["s1"]


def test_empty_input(spark):
    triplets = spark.createDataFrame([], "user_id string, song_id string, play_count int")
    assert clean.active_subset(triplets).count() == 0
    assert [tuple(r) for r in profile.top_user_share(triplets).collect()] == [(0, 0, None)]
    assert profile.class_balance(triplets, "song_id").count() == 0
    assert profile.exact_percentiles(triplets, "play_count", [0.5]).count() == 0
    assert profile.histogram(triplets, "play_count", 5).count() == 0
    assert profile.density(triplets, "play_count").count() == 0


def test_density_of_equal_values_is_undefined(spark):
    df = spark.createDataFrame([(5,), (5,)], "v int")
    assert {r["density"] for r in profile.density(df, "v", 3).collect()} == {None}


def test_both_summary_routes_agree(spark):
    df = spark.createDataFrame([(1, 2.5), (None, 4.0), (7, None), (4, 1.0)], "a int, b double")
    few = profile.feature_summary(df, ["a", "b"]).collect()
    many = profile.feature_summary(df, ["a", "b"], block_columns=1).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, many))
    assert {r["feature"]: r["n"] for r in few} == {"a": 3, "b": 3}


def test_released_tables_are_gone(spark):
    table = freeze(spark.range(3))
    assert table.count() == 3
    models.forget()
    release_tables(spark)
    with pytest.raises(Exception):
        table.count()


@pytest.mark.parametrize("block_columns", [1, 50])
def test_summaries_are_doubles(spark, block_columns):
    df = spark.createDataFrame([(9007199254740993, 1.5), (2, None)], "a bigint, b double")
    rows = {r["feature"]: r for r in profile.feature_summary(df, ["a", "b"], block_columns).collect()}
    assert rows["a"]["max"] == 9007199254740992.0 and rows["b"]["n"] == 1
    assert {f.dataType.simpleString() for f in profile.feature_summary(df, ["a", "b"], block_columns).schema[2:]} == {"double"}


def test_activity_until_stable(spark):
    rows = [(f"u{u}", f"s{s}", 10) for u in range(6) for s in range(u + 1)] + [("u9", s, 10) for s in ("s0", "s1", "rare")]
    triplets = spark.createDataFrame(rows, "user_id string, song_id string, play_count int")
    once = clean.active_subset(triplets, min_plays=30, min_songs=3)
    left = {(u, s): n for u, s, n in rows}
    while True:
        plays, songs = {}, {}
        for (u, s), n in left.items():
            plays[s] = plays.get(s, 0) + n
            songs[u] = songs.get(u, 0) + 1
        kept = {(u, s): n for (u, s), n in left.items() if plays[s] >= 30 and songs[u] >= 3}
        if len(kept) == len(left):
            break
        left = kept
    stable = clean.active_subset(triplets, min_plays=30, min_songs=3, until_stable=True)
    assert {(r["user_id"], r["song_id"]) for r in stable.collect()} == set(left)
    assert 0 < len(left) < once.count()


def test_histogram_of_rows_from_a_shuffled_lookup(spark, facts):
    """Rows that a join has numbered, to spread a hot key, can be put into bins all the same."""
    lookup = freeze(facts.select("key").distinct().withColumn("name", F.upper("key")))
    counts = {}
    for max_bytes in (0, 1 << 30):
        joined = lookup_join(facts, lookup, "key", "inner", max_bytes=max_bytes, task_rows=1, stored=True)
        counts[max_bytes] = sorted(map(tuple, profile.histogram(joined.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "n", 4).collect()))
    assert counts[0] == counts[1 << 30] != []


def test_a_shuffled_lookup_without_hot_keys_is_a_plain_join(spark, facts):
    lookup = freeze(facts.select("key").distinct().withColumn("name", F.upper("key")))
    joined = lookup_join(facts, lookup, "key", "inner", max_bytes=0, stored=True)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan and "_salt" not in plan
