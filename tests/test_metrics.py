"""Metrics against Spark's own evaluators, and by hand."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from harkline.functions.lists import items_by_score
from harkline.operators import correlate, metrics


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        score = rng.choice([rng.random(), round(rng.random(), 1)])
        rows.append((score, int(rng.random() < 0.3 + 0.4 * score), float(score > 0.6), rng.choice("ab")))
    return spark.createDataFrame(rows, "score double, class int, prediction double, model string")


def test_auroc_equals_the_evaluator(predictions):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="class", numBins=0)
    assert metrics.auroc(predictions).head()[0] == pytest.approx(evaluator.evaluate(predictions), abs=1e-12)
    for row in metrics.auroc(predictions, by=["model"]).collect():
        own = predictions.filter(F.col("model") == row["model"])
        assert row["auroc"] == pytest.approx(evaluator.evaluate(own), abs=1e-12)


def test_auroc_of_one_class_is_nan(predictions):
    assert math.isnan(metrics.auroc(predictions.filter("class = 1")).head()[0])


def test_binary_metrics(predictions):
    rows = predictions.collect()
    got = metrics.binary_metrics(predictions).head()
    tp = sum(r["class"] == 1 and r["prediction"] == 1 for r in rows)
    tn = sum(r["class"] == 0 and r["prediction"] == 0 for r in rows)
    assert (got["total"], got["tp"], got["tn"]) == (3000, tp, tn)
    assert got["tp"] + got["fp"] == got["pos_pred"] and got["fn"] + got["tn"] == got["neg_pred"]
    assert got["precision"] == tp / got["pos_pred"] and got["recall"] == tp / got["pos_actual"]
    assert got["accuracy"] == (tp + tn) / 3000


def test_precision_is_nan_without_positive_predictions(predictions):
    got = metrics.binary_metrics(predictions.withColumn("prediction", F.lit(0.0))).head()
    assert math.isnan(got["precision"]) and got["recall"] == 0


def test_multiclass_metrics_equal_the_evaluator(spark):
    rng = random.Random(8)
    rows = [(float(rng.randrange(4)), float(rng.randrange(4))) for _ in range(500)]
    df = spark.createDataFrame(rows, "class double, prediction double")
    evaluator = MulticlassClassificationEvaluator(labelCol="class", predictionCol="prediction")
    for row in metrics.multiclass_metrics(df).collect():
        for name, metric in [("precision", "precisionByLabel"), ("recall", "recallByLabel")]:
            expected = evaluator.setMetricName(metric).setMetricLabel(float(row["class"])).evaluate(df)
            assert row[name] == pytest.approx(expected)
        both = sum((c == row["class"]) == (p == row["class"]) for c, p in rows)
        assert row["accuracy"] == pytest.approx(both / 500)


def test_ranking_by_hand(spark):
    recommended = spark.createDataFrame([("u", i, i) for i in range(1, 6)], "user_id string, position int, song_id int")
    relevant = spark.createDataFrame([("u", 1), ("u", 3), ("u", 9), ("other", 1)], "user_id string, song_id int")
    got = metrics.ranking_metrics(recommended, relevant, 10).head()
    assert got["n_users"] == 1
    assert got["precision_at_k"] == pytest.approx(0.2)
    assert got["ndcg_at_k"] == pytest.approx(0.70392, abs=1e-5)
    assert got["map_at_k"] == pytest.approx(0.55556, abs=1e-5)


@pytest.mark.parametrize("k", [3, 5, 10])
def test_ranking_equals_the_library(spark, k):
    rng = random.Random(k)
    lists = {u: (rng.sample(range(40), rng.randint(3, 12)), rng.sample(range(40), rng.randint(1, 20))) for u in range(60)}
    recommended = spark.createDataFrame(
        [(u, p, s) for u, (songs, _) in lists.items() for p, s in enumerate(songs, 1)], "user_id int, position int, song_id int"
    )
    relevant = spark.createDataFrame([(u, s) for u, (_, songs) in lists.items() for s in songs], "user_id int, song_id int")
    got = metrics.ranking_metrics(recommended, relevant, k).head()
    pairs = [(list(map(float, a)), list(map(float, b))) for a, b in lists.values()]
    library = RankingMetrics(spark.sparkContext.parallelize(pairs))
    assert got["n_users"] == 60
    assert got["precision_at_k"] == pytest.approx(library.precisionAt(k), abs=1e-12)
    assert got["ndcg_at_k"] == pytest.approx(library.ndcgAt(k), abs=1e-12)
    assert got["map_at_k"] == pytest.approx(library.meanAveragePrecisionAt(k), abs=1e-12)


def test_items_by_score(spark):
    df = spark.createDataFrame([([(1, 0.5), (4, 0.9), (3, 0.9), (2, 0.1)],), ([],)], "r array<struct<item:int,score:float>>")
    ordered = items_by_score(F.col("r"), "item", "score")
    listed = df.select(ordered.alias("all"), items_by_score(F.col("r"), "item", "score", 2).alias("top"))
    assert [(r["all"], r["top"]) for r in listed.collect()] == [([3, 4, 1, 2], [3, 4]), ([], [])]


def test_correlation_in_blocks_of_columns(spark):
    df = spark.range(200).selectExpr("rand(1) AS a", "rand(1) + rand(2) / 4 AS b", "-rand(1) AS c", "1.0D AS d")
    x = np.array(df.select("a", "b", "c").collect())
    want = np.corrcoef(x.T)
    for block in (1, 2, 128):
        for parts in (1, 7):
            got = {(r["i"], r["j"]): r["corr"] for r in correlate.feature_correlation(df.repartition(parts), ["a", "b", "c"], block).collect()}
            assert got == {(i, j): pytest.approx(want["abc".index(i), "abc".index(j)], abs=1e-12) for i, j in ("ab", "ac", "bc")}
    everything = correlate.feature_correlation(df, ["a", "b", "c", "d"])
    assert {(r["i"], r["j"]) for r in correlate.high_correlation_pairs(everything).collect()} == {("a", "b")}
    strong = correlate.high_correlation_pairs(everything, absolute=True).collect()
    assert ("b", "c") in {(r["i"], r["j"]) for r in strong}


def test_macro_auroc_leaves_out_classes_without_one(spark):
    areas = spark.createDataFrame([(0, 0.5), (1, 1.0), (2, float("nan")), (3, None)], "class int, auroc double")
    row = metrics.macro_auroc(areas).head()
    assert (row["n_classes"], row["macro_auroc"]) == (2, 0.75)


def test_correlation_of_many_columns_in_passes(spark, monkeypatch):
    """Three hundred columns with a large mean, in blocks of which a task holds two pairs at a time."""
    monkeypatch.setattr(correlate.co_moments, "__defaults__", (correlate.BLOCK, 2 * 8 * 100**2))
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 300)) @ rng.normal(size=(300, 300)) + 1e6
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(5)
    wide = df.select(*[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(300)])
    got = {(r["i"], r["j"]): r["corr"] for r in correlate.feature_correlation(wide, wide.columns, 100).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 300 * 299 // 2
    assert max(abs(c - want[int(i[1:]), int(j[1:])]) for (i, j), c in got.items()) < 1e-8


def test_co_moments_merge_exactly():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(100, 3)) + 50, rng.normal(size=(100, 2))
    whole, parts = correlate.CoMoments.of(a, b), [correlate.CoMoments.of(a[s], b[s]) for s in (slice(0, 1), slice(1, 40), slice(40, 100))]
    merged = parts[0].merge(parts[1]).merge(parts[2])
    assert merged.n == 100 and np.allclose(merged.moments, whole.moments) and np.allclose(merged.mean_a, a.mean(0))


@pytest.mark.parametrize("block", [1, 128])
def test_correlation_of_few_or_missing_rows(spark, block):
    def corr(rows, **more):
        df = spark.createDataFrame(rows, "a double, b int")
        return [r["corr"] for r in correlate.feature_correlation(df, ["a", "b"], block=block, **more).collect()]

    assert all(math.isnan(c) for c in corr([]) + corr([(1.0, 2)]) + corr([(1.0, 2), (1.0, 3)]))
    rows = [(1.0, 2), (2.0, 4), (3.0, 6), (None, 1), (float("nan"), 5)]
    assert corr(rows, handle_invalid="skip") == pytest.approx([1.0])
    with pytest.raises(Exception, match="(?i)null|missing|nan"):
        corr(rows[:4])
    with pytest.raises(Exception, match="(?i)null|missing|nan"):
        corr([*rows[:3], rows[4]])
    with pytest.raises(ValueError):
        corr(rows, handle_invalid="keep")
