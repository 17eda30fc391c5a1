"""Models learn a learnable label, and recommendations keep their promises."""

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from harkline.operators import classify, ensembles, features, metrics, sampling
from harkline.operators.frozen import freeze
from harkline.operators.recommend import fit_recommender
from harkline.plans import models, tables as t
from harkline.session import scratch_dir

KEY = ["track_id"]


@pytest.fixture(scope="module")
def sides(spark, sf):
    """Tracks with a class that follows from a feature."""
    tracks = t.labelled_features(spark, sf).withColumn("class", F.when(F.col("n") > 33, 1).otherwise(0))
    split = sampling.stratified_split(freeze(tracks), "class", KEY, fraction=0.7)
    vectors = freeze(features.assemble(split, t.FEATURES))
    return sampling.training(vectors), sampling.holdout(vectors)


def test_every_model_learns(sides):
    train, test = sides
    models = classify.fit_all(train, KEY, learners=["logistic regression", "random forest"])
    assert len(models) == 7
    compared = classify.compare_models(models, test).collect()
    assert len(compared) == 7
    assert all(r["auroc"] > 0.9 and r["total"] == test.count() for r in compared)


def test_boosted_trees_are_tuned_without_copies_across_folds(sides):
    train, test = sides
    best, settings = classify.tune_boosted_trees(
        train, KEY, sampling_rates=[1.0], iterations=[2, 4], depths=[3], folds=2, parallelism=1
    )
    rows = settings.collect()
    assert [(r["iterations"], r["depth"]) for r in rows] == [(2, 3), (4, 3)]
    assert all(r["auroc"] > 0.8 for r in rows)
    assert metrics.auroc(classify.score(best, test, KEY)).head()[0] > 0.8


def test_rebalanced_estimator_fits_on_rebalanced_rows(sides):
    train, _ = sides
    seen = []

    def rebalance(rows):
        seen.append(rows.count())
        return rows

    forest = classify.random_forest()
    estimator = classify.Rebalanced(forest, rebalance)
    model = estimator.fit(train, {forest.numTrees: 3})
    assert model.getNumTrees == 3 and seen == [train.count()]


def test_full_grid_is_the_default():
    import inspect

    defaults = {n: p.default for n, p in inspect.signature(classify.tune_boosted_trees).parameters.items()}
    size = len(defaults["sampling_rates"]) * len(defaults["iterations"]) * len(defaults["depths"])
    assert (size, defaults["folds"]) == (48, 3)


def test_both_queries_share_one_search_of_the_full_grid(spark, sf, sides, monkeypatch):
    searches = []
    small = classify.tune_boosted_trees

    def search(train, keys, **cut):
        searches.append(cut)
        return small(train, keys, sampling_rates=[1.0], iterations=[2], depths=[3], folds=2)

    models.forget()
    monkeypatch.setattr(classify, "tune_boosted_trees", search)
    monkeypatch.setattr(models, "binary_sides", lambda *_: sides)
    try:
        assert models.cv_grid(spark, sf).count() == 1 and models.tuned_metrics(spark, sf).count() == 1
    finally:
        models.tuned.cache_clear()
    assert searches == [{}]  # nothing of the default grid is left out


def test_label_index_orders_by_frequency_then_label(spark, monkeypatch):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "genre string")
    indexer = features.label_indexer(df, "genre")
    assert list(indexer.labels) == ["c", "a", "b"]
    monkeypatch.setattr(features, "MAX_LABELS", 2)
    with pytest.raises(ValueError):
        features.label_indexer(df, "genre")


def test_feature_columns_must_be_numbers(spark):
    df = spark.createDataFrame([("t", 1.0, "x")], "track_id string, a double, b string")
    assert features.feature_columns(df.drop("b"), ["track_id"]) == ["a"]
    with pytest.raises(TypeError):
        features.feature_columns(df, ["track_id"])


@pytest.fixture(scope="module")
def plays(spark, sf):
    split = freeze(sampling.random_split(t.clean_triplets(spark, sf), ["user_id", "song_id"]))
    train = sampling.training(split)
    return train, sampling.warm_users(sampling.holdout(split), train)


@pytest.fixture(scope="module")
def recommender(plays):
    return fit_recommender(plays[0], rank=5, iterations=3)


def test_every_training_user_gets_a_list(plays, recommender):
    rows = recommender.recommend(4).collect()
    assert {r["user_id"] for r in rows} == {r["user_id"] for r in plays[0].select("user_id").distinct().collect()}
    lists = {}
    for r in rows:
        lists.setdefault(r["user_id"], []).append(r)
    for listed in lists.values():
        listed.sort(key=lambda r: r["position"])
        assert [r["position"] for r in listed] == [1, 2, 3, 4]
        assert len({r["song_id"] for r in listed}) == 4
        assert all(a["rating"] >= b["rating"] for a, b in zip(listed, listed[1:]))
    plain = recommender.recommended_items(4).count()
    assert plain == len(rows)


def test_scores_are_dot_products(plays, recommender):
    factors = {(r["kind"], r["name"]): r["features"] for r in recommender.factors().collect()}
    scored = recommender.score(plays[1]).limit(50).collect()
    for r in scored:
        dot = sum(a * b for a, b in zip(factors["user", r["user_id"]], factors["song", r["song_id"]]))
        assert r["prediction"] == pytest.approx(dot, abs=1e-4)


def test_unknown_ids_are_dropped(spark, recommender, plays):
    known = plays[0].limit(1).collect()[0]
    rows = [(known["user_id"], known["song_id"], 1), (known["user_id"], "no such song", 1), ("nobody", known["song_id"], 1)]
    indexed = recommender.index(spark.createDataFrame(rows, "user_id string, song_id string, play_count int"))
    assert indexed.count() == 1


def test_scores_of_sampled_users_cover_all_their_test_songs(plays, recommender):
    sampled = recommender.sampled_user_scores(plays[1], users=3).collect()
    users = {r["user_id"] for r in sampled}
    assert len(users) == 3
    known = recommender.index(plays[1]).filter(F.col("user_id").isin(list(users)))
    assert len(sampled) == known.count()


def test_multiclass_probabilities_are_arrays(sides):
    train, test = sides
    scored = classify.score_classes(classify.random_forest().fit(train), test, KEY)
    assert dict(scored.dtypes)["probability"] == "array<double>"
    got = {r["class"]: r["auroc"] for r in metrics.ovr_auroc(scored).collect()}
    assert got[0] == pytest.approx(got[1]) and got[1] > 0.9


@pytest.fixture(scope="module")
def boosted(sides):
    """A long fit and a short one of the same settings, with rows left out at random."""
    train, _ = sides
    return [classify.boosted_trees().setSubsamplingRate(0.5).setMaxDepth(3).setMaxIter(n).fit(train) for n in (6, 3)]


def scores(model, rows):
    return [r["score"] for r in classify.score(model, rows, KEY).orderBy(*KEY).collect()]


def test_first_rounds_are_the_shorter_fit(sides, boosted):
    long, short = boosted
    assert ensembles.first_rounds(long, 6) is long
    assert scores(ensembles.first_rounds(long, 3), sides[1]) == scores(short, sides[1])
    assert scores(ensembles.first_rounds(long, 3), sides[1]) != scores(long, sides[1])


def test_staged_search_equals_separate_fits(sides):
    """Every setting's area, against a fit of its own on each fold."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from harkline.functions.draws import draw

    train, _ = sides
    grid = {"sampling_rates": [0.5, 1.0], "iterations": [2, 4], "depths": [2, 3]}
    best, settings = classify.tune_boosted_trees(train, KEY, **grid, folds=2)
    folded = freeze(train.withColumn("fold", F.floor(draw(KEY, "fold", 42) * 2).cast("int")))
    fits = [freeze(classify._few_parts(sampling.upsample(folded.filter(F.col("fold") != i), "class", KEY).select("features", "class"))) for i in range(2)]
    evaluator = BinaryClassificationEvaluator(labelCol="class", numBins=0)
    rows = settings.collect()
    assert [(r["sampling_rate"], r["iterations"], r["depth"]) for r in rows] == [(s, n, d) for s in grid["sampling_rates"] for n in grid["iterations"] for d in grid["depths"]]
    for r in rows[1::3]:
        gbt = classify.boosted_trees().setSubsamplingRate(r["sampling_rate"]).setMaxIter(r["iterations"]).setMaxDepth(r["depth"])
        areas = [evaluator.evaluate(gbt.fit(fits[i]).transform(folded.filter(F.col("fold") == i))) for i in range(2)]
        assert r["auroc"] == pytest.approx(sum(areas) / 2, abs=1e-9)
    top = max(rows, key=lambda r: r["auroc"])
    assert (best.getNumTrees, best.getOrDefault("maxDepth")) == (top["iterations"], top["depth"])


@pytest.mark.parametrize("parts", [1, 3])
def test_fits_side_by_side_are_the_separate_fits(spark, parts):
    """Margins of every fit after some and all rounds, on more rows than splits are taken from; the jobs do not grow with the fits."""
    from pyspark.ml.linalg import Vectors

    from harkline.operators import boosting

    made = [((i * 7919 % 101 > 40) * 1, Vectors.dense([float(i * 7919 % 101 + i % 7), i * i % 977 / 3, 0.0 if i % 3 else float(i % 50), 7.0])) for i in range(12_000)]
    rows = freeze(spark.createDataFrame(made, ["class", "features"]).coalesce(1) if parts == 1 else spark.createDataFrame(made, ["class", "features"]).repartition(parts))
    other = freeze(rows.limit(500).coalesce(1))
    splits = [boosting.candidate_splits(side, 42) for side in (rows, other)]
    assert len(splits[0][3]) <= 1 and len(splits[0][0]) > 20

    def grown(rates, depths, rounds):
        spark.sparkContext.setJobGroup(name := f"boost {parts} {rates} {depths}", "")
        try:
            trees = boosting.boost([rows, other], splits, rates, depths, rounds, 42)
            return trees, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    written = lambda: {p.name for p in Path(urlparse(scratch_dir(spark)).path).glob("rdd-*")}
    before = written()
    trees, jobs = grown([0.5, 1.0], [2, 3], 12)
    assert jobs <= 12 * 3 + 4
    assert written() <= before  # margins written down on the way are deleted
    for side, rate, depth, fitted in ((0, 0, 1, rows), (0, 1, 0, rows), (1, 0, 0, other)):
        model = classify.boosted_trees().setSubsamplingRate([0.5, 1.0][rate]).setMaxDepth([2, 3][depth]).setMaxIter(12).fit(fitted)
        found = boosting.staged_margins(rows, splits[side], [trees[side, rate, depth]], [3, 12]).collect()
        for n in (3, 12):
            said = ensembles.first_rounds(model, n).transform(rows).select(F.col("class"), vector_to_array("rawPrediction")[1].alias("m")).collect()
            assert [r[f"m0_{n}"] for r in found] == pytest.approx([r["m"] for r in said], abs=1e-9)


def binned_block(n_rows, rate, rounds, exact, n_bins=40, start=0):
    """A block of made-up rows with more than 32 bins, and five features, of which one says nothing."""
    import numpy as np

    from harkline.operators import boosting

    i = np.arange(start, start + n_rows)
    bins = np.stack([i * 7919 % 101 % n_bins, i * i % 977 % n_bins, i % 13, 0 * i, i * 31 % 211 % n_bins]).astype(np.uint8)
    label = np.where((bins[0] > 19) ^ (bins[1] < 7) ^ (i * 104729 % 10 == 0), 1, -1).astype(np.int8)
    drawn = None if rate == 1 else np.stack([(i * (2 * m + 3) * 2654435761 % 1000) / 1000 < rate for m in range(rounds)])
    return boosting._Block(0, 0, (0, start), bins, label, None if drawn is None else np.packbits(drawn, axis=1), exact)


@pytest.mark.parametrize("rate", [0.5, 1.0])
def test_sums_of_pairs_and_smaller_children_are_the_direct_sums(rate):
    """Trees of three blocks by pairs of features, against those of one block in the order of the rows; all leaves have their rows."""
    import numpy as np

    from harkline.operators import boosting

    n_splits, rounds = [39, 39, 12, 0, 39], 5
    direct = boosting._fitted([binned_block(6_000, rate, rounds, True)], n_splits, 3, rounds, True)
    paired = boosting._fitted([binned_block(2_000, rate, rounds, False, start=2_000 * k) for k in range(3)], n_splits, 3, rounds, True)
    bins = binned_block(6_000, rate, rounds, True).bins
    for one, other in zip(direct, paired):
        assert (one.feature == other.feature).all() and (one.bin == other.bin).all() and (one.feature != 3).all()
        assert other.value == pytest.approx(one.value, abs=1e-12) and other.leaves == pytest.approx(one.leaves, abs=1e-6)
        codes = boosting._paired(bins, 40).astype(np.intp)
        assert (boosting._said(boosting._ways(one, 5, 40), codes) == one.value.take(one.reached(bins))).all()


def test_large_sides_are_grown_in_one_job_and_larger_ones_by_levels(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from harkline.operators import boosting

    made = [(int((i * 7919 % 101 > 40) ^ (i * 104729 % 9 == 0)), Vectors.dense([float(i * 7919 % 101 + i % 7), i * i % 977 / 3, float(i % 50)])) for i in range(6_000)]
    rows = freeze(spark.createDataFrame(made, ["class", "features"]).repartition(3))
    splits = [boosting.candidate_splits(rows, 42)]

    def grown(name):
        spark.sparkContext.setJobGroup(name, "")
        try:
            return boosting.boost([rows], splits, [0.5, 1.0], [2, 3], 15, 42), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    whole, jobs = grown("whole")
    assert jobs <= 3  # the rows are counted, dealt to tasks, and fitted
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    levels, jobs = grown("levels")
    assert jobs > 15 and whole.keys() == levels.keys()
    for lane, trees in whole.items():
        assert len(trees) == 15
        for one, other in zip(trees, levels[lane]):
            assert len(one.feature) == len(other.feature)
        said = [[r["m0_15"] for r in boosting.staged_margins(rows, splits[0], [fit], [15]).collect()] for fit in (trees, levels[lane])]
        assert said[0] == pytest.approx(said[1], abs=1e-9)


def test_a_grown_model_is_the_fitted_one(spark, monkeypatch):
    """Trees, settings and importances of the model made of grown trees, on rows of several parts."""
    from pyspark.ml.linalg import Vectors

    made = [(int((i * 7919 % 101 > 40) ^ (i * 104729 % 9 == 0)), Vectors.dense([float(i * 7919 % 101 + i % 7), i * i % 977 / 3, 0.0 if i % 3 else float(i % 50)])) for i in range(6_000)]
    rows = freeze(spark.createDataFrame(made, ["class", "features"]).repartition(3))
    learner = classify.boosted_trees().setSubsamplingRate(0.5).setMaxDepth(3).setMaxIter(5)
    fitted = classify._refitted(learner, rows)
    monkeypatch.setattr(classify, "FIT_ROWS", 100)
    grown = classify._refitted(learner, rows)
    assert type(grown) is type(fitted) and grown.getNumTrees == 5 and grown.treeWeights == fitted.treeWeights
    assert {p.name: v for p, v in grown.extractParamMap().items()} == {p.name: v for p, v in fitted.extractParamMap().items()}
    assert [t.numNodes for t in grown.trees] == [t.numNodes for t in fitted.trees]
    assert list(grown.featureImportances.toArray()) == pytest.approx(list(fitted.featureImportances.toArray()), abs=1e-9)
    said = [[r["m"] for r in m.transform(rows).select(vector_to_array("rawPrediction")[1].alias("m")).collect()] for m in (grown, fitted)]
    assert said[0] == pytest.approx(said[1], abs=1e-9)


def test_areas_of_all_columns_are_the_evaluators(spark, monkeypatch):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from harkline.operators import boosting

    made = [(i * 31 % 7 // 5, float(i * 17 % 23), i * 7919 % 101 / 7, 1.0) for i in range(500)]
    rows = freeze(spark.createDataFrame(made, "class int, m0_2 double, m0_4 double, m1_2 double").repartition(3))

    def said(rows):
        evaluator = BinaryClassificationEvaluator(labelCol="class", numBins=0)
        return {c: evaluator.evaluate(rows.select("class", F.col(c).alias("rawPrediction"))) for c in rows.columns[1:]}

    assert boosting.areas(rows) == pytest.approx(said(rows))
    for some in (rows.filter("class = 0"), rows.filter("class = 1"), rows.filter("class > 1")):
        assert boosting.areas(some) == pytest.approx(said(some))
    held = boosting.areas(rows)
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    assert boosting.areas(rows) == held


def test_sides_that_cannot_be_fitted(spark):
    from pyspark.ml.linalg import Vectors

    from harkline.operators import boosting

    rows = freeze(spark.createDataFrame([(2, Vectors.dense([1.0])), (0, Vectors.dense([2.0]))], ["class", "features"]))
    with pytest.raises(ValueError):
        boosting.candidate_splits(rows.filter("class > 2"), 42)
    with pytest.raises(Exception, match="classes must be 0 or 1"):
        boosting.boost([rows], [boosting.candidate_splits(rows, 42)], [1.0], [2], 2, 42)


def test_boosted_trees_as_a_table(sides, boosted):
    """Margins of the table, all rounds and the first, are the model's raw scores: twice the margin."""
    _, test = sides
    leaves = freeze(ensembles.leaves_reached(ensembles.tree_table(boosted[0]), test, KEY))
    for rounds, model in ((None, boosted[0]), (3, boosted[1])):
        margins = [r["margin"] for r in ensembles.boosted_margin(leaves, KEY, rounds).orderBy(*KEY).collect()]
        # The library's raw score of class 1 is the margin, of class 0 its negative.
        assert margins == pytest.approx(scores(model, test))


def test_a_forest_as_a_table(sides):
    train, test = sides
    model = classify.random_forest().setNumTrees(4).fit(train)
    votes = ensembles.forest_votes(ensembles.leaves_reached(ensembles.tree_table(model), test, KEY), KEY)
    got = {(r["track_id"], r["at"]): r["share"] for r in votes.collect()}
    for r in classify.score_classes(model, test, KEY).collect():
        assert [got[r["track_id"], c] for c in (0, 1)] == pytest.approx(r["probability"])


def test_a_tree_of_one_leaf(spark, sides):

    train, test = sides
    model = classify.random_forest().setNumTrees(2).setMaxDepth(0).fit(train)
    nodes = ensembles.tree_table(model)
    assert nodes.count() == 2 and nodes.filter("feature IS NOT NULL").count() == 0
    assert ensembles.leaves_reached(nodes, test, KEY).count() == 2 * test.count()


def test_leaves_hold_what_their_round_fitted(spark, sides):
    train, _ = sides
    model = classify.boosted_trees().setMaxIter(4).setMaxDepth(3).fit(train)
    nodes = ensembles.tree_table(model)
    errors = ensembles.leaf_errors(nodes, train, KEY).collect()
    assert {r["tree"] for r in errors} == {0, 1, 2, 3}
    assert all(r["value"] == pytest.approx(r["expected"], abs=1e-9) for r in errors)
    assert all(sum(r["n_rows"] for r in errors if r["tree"] == i) == train.count() for i in range(4))
    # With other values in one tree, it and those after it do not fit.
    mixed = nodes.withColumn("value", F.when(F.col("tree") == 1, F.col("value") + 0.1).otherwise(F.col("value")))
    wrong = {r["tree"] for r in ensembles.leaf_errors(mixed, train, KEY).collect() if abs(r["value"] - r["expected"]) > 1e-6}
    assert wrong == {1, 2, 3}


@pytest.mark.parametrize("weight", [None, "weight"])
def test_the_loss_is_flat_at_its_optimum_only(sides, weight):
    train = sampling.class_weight(sides[0], "class")
    slopes = lambda rounds, reg=0.3: [
        r["gradient"] for r in classify.loss_gradient(classify.logistic_regression(weight).setMaxIter(rounds).setTol(1e-12).setRegParam(reg).fit(train), train, weight).collect()
    ]
    assert len(slopes(100)) == len(t.FEATURES) + 1
    assert max(map(abs, slopes(100))) < 1e-6 < 1e-4 < max(map(abs, slopes(1)))
    # Fitted with other weights, the same coefficients are no optimum.
    other = classify.logistic_regression(None if weight else "weight").setMaxIter(100).setTol(1e-12).fit(train)
    assert max(abs(r["gradient"]) for r in classify.loss_gradient(other, train, weight).collect()) > 1e-4


def test_gradient_of_a_constant_feature(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(i % 2, Vectors.dense([float(i % 3), 7.0])) for i in range(30)], ["class", "features"])
    found = {r["term"]: r["gradient"] for r in classify.loss_gradient(classify.logistic_regression().fit(rows), rows).collect()}
    assert found[1] == 0.0 and set(found) == {-1, 0, 1}


def test_factors_solve_their_equations(spark, plays, recommender):
    import dataclasses

    import numpy as np

    rows = {r["user_id"]: r for r in recommender.residuals(plays[0]).collect()}
    assert set(rows) == {r["user_id"] for r in plays[0].select("user_id").distinct().collect()}
    assert max(r["residual"] for r in rows.values()) < 1e-4
    # The same by arrays, with another regularization, under which they do not.
    wrong = dataclasses.replace(recommender, regularization=3.0)
    factors = {(r["kind"], r["name"]): np.array(r["features"], float) for r in recommender.factors().collect()}
    y = np.array([v for (kind, _), v in factors.items() if kind == "song"])
    of_user = {}
    for r in plays[0].collect():
        of_user.setdefault(r["user_id"], []).append((factors["song", r["song_id"]], r["play_count"]))
    for r in wrong.residuals(plays[0]).limit(20).collect():
        x, own = factors["user", r["user_id"]], of_user[r["user_id"]]
        left = y.T @ y @ x + sum(c * v * (v @ x) for v, c in own) + 3.0 * len(own) * x
        right = sum((1 + c) * v for v, c in own)
        assert r["n_songs"] == len(own) and r["residual"] > 1e-3
        assert r["residual"] == pytest.approx(np.linalg.norm(left - right) / np.linalg.norm(right), rel=1e-6)
