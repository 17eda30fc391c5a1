"""Bucketed tables, sketches that add up, and rows put aside."""

import oracle
import pytest
from pyspark.sql import functions as F, types as T

from harkline.operators import sketches
from harkline.operators.frozen import freeze, freeze_by
from harkline.plans import splits
from harkline.session import BUCKETED, release_tables
from harkline.sources import text


def exchanges(df):
    """Shuffles of the plan, from its last written table on."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_bucketed_rows_do_not_move_again(spark, sf):
    warm = splits.bucketed_warm_users(spark, sf, 6)
    assert exchanges(warm) == 0 and "SortMergeJoin" in warm._jdf.queryExecution().executedPlan().toString()
    split = freeze(splits.triplet_split(spark, sf))
    users = split.filter("in_train").select("user_id").distinct()
    plain = split.filter("not in_train").join(users.hint("merge"), "user_id", "left_semi")
    assert exchanges(plain) > 0
    assert oracle.spark_rows(warm)[1] == oracle.spark_rows(plain.select(*warm.columns))[1]


def test_two_bucketed_tables_meet_where_they_are(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 90).cast("string").alias("key"), "id")
    one, other = freeze_by(rows, "key", 5), freeze_by(rows.groupBy("key").count(), "key", 5)
    joined = one.join(other.hint("merge"), "key").groupBy("key").agg(F.count("*").alias("n"))
    assert exchanges(joined) == 0 and joined.agg(F.sum("n")).head()[0] == 2000
    nothing = freeze_by(rows.limit(0), "key", 5)
    assert nothing.count() == 0


def test_bucketed_tables_are_released(spark):
    name = len(BUCKETED)
    freeze_by(spark.range(10), "id", 2)
    assert len(BUCKETED) == name + 1
    made = BUCKETED[-1]
    before = list(BUCKETED)
    # Only this table, as other tests go on with theirs.
    del BUCKETED[:-1]
    spark.sql(f"DROP TABLE {BUCKETED.pop()}")
    BUCKETED.extend(before[:-1])
    assert not spark.catalog.tableExists(made) and callable(release_tables)


@pytest.mark.parametrize("n", [0, 50, 20_000])
def test_sketches_of_parts_add_up(spark, n):
    df = spark.range(3 * n).select((F.col("id") % max(n, 1)).alias("v"), (F.col("id") % 7).alias("part"), F.lit(None).cast("string").alias("w"))
    parts = freeze(sketches.distinct_sketches(df, ["v", "w"], "part"))
    merged = {r["column"]: r for r in sketches.merged_distinct(parts).collect()}
    if not n:
        assert merged == {}
        return
    assert merged["v"]["n_parts"] == 7 and merged["w"]["n_distinct"] == 0
    assert abs(merged["v"]["n_distinct"] - n) <= 4 * sketches.STANDARD_ERROR * n + 1
    # A part that comes later changes the union only by what it adds.
    more = spark.range(n, 2 * n).select(F.col("id").alias("v"), F.lit(9).cast("long").alias("part"))
    later = sketches.merged_distinct(parts.filter("column = 'v'").unionByName(sketches.distinct_sketches(more, ["v"], "part"))).head()
    assert later["n_parts"] == 8 and abs(later["n_distinct"] - 2 * n) <= 8 * sketches.STANDARD_ERROR * n + 1


LINES = ["u1\ts1\t3", "u2\ts2", "u3\ts3\t4\t5", "u4\ts4\tfour", "u5\ts5\t", "", "u6\ts6\t99999999999", "u7\t\t1", "u8\ts8\t8"]


def test_rows_that_do_not_fit_are_put_aside(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("\n".join(LINES[:5]) + "\n")
    (tmp_path / "b.tsv").write_text("\n".join(LINES[5:]) + "\n")
    good, bad = text.read_checked(spark, str(tmp_path), text.TRIPLET_SCHEMA, sep="\t")
    assert sorted(map(tuple, good.collect()), key=repr) == [("u1", "s1", 3), ("u5", "s5", None), ("u7", None, 1), ("u8", "s8", 8)]
    got = sorted((r["file"][-5:], r["line"], r["reason"]) for r in bad.collect())
    assert got == [("a.tsv", LINES[1], "fields"), ("a.tsv", LINES[2], "fields"), ("a.tsv", LINES[3], "types"), ("b.tsv", LINES[6], "types")]
    # However few columns are asked for.
    assert good.count() == 4 and bad.count() == 4 and good.select("song_id").count() == 4


def test_checked_rows_with_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,2\nx,3\n4\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.IntegerType())])
    good, bad = text.read_checked(spark, str(tmp_path), schema, header=True)
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert sorted((r["line"], r["reason"]) for r in bad.collect()) == [("4", "fields"), ("x,3", "types")]
