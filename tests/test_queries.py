"""Every registered query, against its SQL twin where it has one."""

import oracle
import pytest
from __spark_entry__ import QUERIES, entry, oracle_sql, queries

WITH_SQL = sorted(oracle_sql())
WITHOUT_SQL = sorted(set(queries()) - set(oracle_sql()))
SQL_TYPES = {"double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}

# Operators that would pair all rows, or take rows out of the JVM one by one.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="session")
def duck(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    assert oracle.spark_rows(df) == oracle.sql_rows(duck, oracle_sql()[name])
    described = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()}
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema} == described
    plan = df._jdf.queryExecution().toString()
    assert not [word for word in UNWANTED if word in plan]


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_has_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", ["stratified_split_multi", "shuffled", "upsample", "ranked_items", "ovr_auroc", "test_index"])
def test_partitioning_does_not_matter(spark, sf, name):
    def rows(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            return oracle.spark_rows(queries()[name](spark, sf))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    assert rows(3) == rows(7)


def test_scans_read_only_what_they_need(spark, sf):
    plan = QUERIES["clean_triplets"].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "LeftAnti" in plan
