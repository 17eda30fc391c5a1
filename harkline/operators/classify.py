"""Genre classifiers: fitting, scoring, comparing and tuning them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from harkline.functions.draws import SEED, draw
from harkline.operators import boosting, ensembles, metrics, sampling
from harkline.operators.frozen import freeze


def logistic_regression(weight: str | None = None) -> LogisticRegression:
    lr = LogisticRegression(labelCol="class", maxIter=20, regParam=0.3)
    return lr if weight is None else lr.setWeightCol(weight)


def random_forest(seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="class", seed=seed)


def boosted_trees(seed: int = SEED) -> GBTClassifier:
    return GBTClassifier(labelCol="class", seed=seed)


LEARNERS: dict[str, Callable[[], Estimator]] = {
    "logistic regression": logistic_regression,
    "random forest": random_forest,
    "boosted trees": boosted_trees,
}

# How a training set is balanced: name -> (training set, keys) -> training set.
TREATMENTS: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {
    "plain": lambda train, keys: train,
    "downsampled": lambda train, keys: sampling.downsample(train, "class", keys),
    "upsampled": lambda train, keys: sampling.upsample(train, "class", keys),
}


def fit_all(
    train: DataFrame, keys: Sequence[str], learners: Sequence[str] = tuple(LEARNERS), parallelism: int = 4
) -> dict[tuple[str, str], Model]:
    """Every learner on every treatment, and logistic regression on weighted rows.

    Each treated set is written down once, for all learners that use it. Up to
    ``parallelism`` fits share the cluster at a time.
    """
    fits: dict[tuple[str, str], tuple[Estimator, DataFrame]] = {}
    for treatment, treat in TREATMENTS.items():
        treated = freeze(treat(train, keys).select("features", "class"))
        for learner in learners:
            fits[learner, treatment] = LEARNERS[learner](), treated
    if "logistic regression" in learners:
        weighted = freeze(sampling.class_weight(train, "class").select("features", "class", "weight"))
        fits["logistic regression", "weighted"] = logistic_regression("weight"), weighted

    with ThreadPoolExecutor(parallelism) as pool:
        fit = inheritable_thread_target(train.sparkSession)(lambda estimator_and_rows: estimator_and_rows[0].fit(estimator_and_rows[1]))
        return dict(zip(fits, pool.map(fit, fits.values())))


def score(model: Model, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, class, prediction, score)`` of a binary model; the score is that of class 1."""
    return model.transform(rows).select(
        *keys, "class", "prediction", vector_to_array("rawPrediction")[1].alias("score")
    )


def score_classes(model: Model, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, class, prediction, probability)`` with an array of class probabilities."""
    return model.transform(rows).select(
        *keys, "class", "prediction", vector_to_array("probability").alias("probability")
    )


def loss_gradient(model: LogisticRegressionModel, rows: DataFrame, weight: str | None = None, features: str = "features") -> DataFrame:
    """``(term, coefficient, gradient)``: the slope of the regularised loss at a fitted model, 0 at its optimum.

    ``term`` is a feature's place, -1 the intercept. The loss is the weighted mean of the logistic losses plus half ``regParam`` times the
    squares of the coefficients of features scaled to a standard deviation of 1, which is what the fit minimises; gradients are of the
    scaled coefficients. Two passes of sums over the rows; a constant feature has a gradient of 0.
    """
    spark = rows.sparkSession
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    terms = rows.select(F.col("class").cast("double").alias("y"), w.alias("w"), vector_to_array(F.col(features)).alias("x"))
    at = [(-1, float(model.intercept)), *((i, float(c)) for i, c in enumerate(model.coefficients))]
    fitted = spark.createDataFrame(at, "term int, coefficient double")
    total, squares = F.sum("w"), F.sum(F.col("w") * F.col("w"))
    spread = terms.select("w", F.posexplode("x").alias("term", "v")).groupBy("term").agg(
        total.alias("total"), squares.alias("squares"), (F.sum(F.col("w") * F.col("v")) / total).alias("mean")
    )
    centred = terms.select("w", F.posexplode("x").alias("term", "v")).join(F.broadcast(spread), "term")
    scales = centred.groupBy("term").agg(
        F.sqrt(F.sum(F.col("w") * F.pow(F.col("v") - F.col("mean"), 2)) / (F.max("total") - F.max("squares") / F.max("total"))).alias("scale")
    )
    margin = F.aggregate(F.zip_with("x", F.array(*[F.lit(c) for _, c in at[1:]]), lambda a, b: a * b), F.lit(at[0][1]), lambda a, b: a + b)
    off = terms.select("w", "x", (F.col("w") * (1 / (1 + F.exp(-margin)) - F.col("y"))).alias("off"))
    slopes = off.select("w", "off", F.explode(F.array_prepend(F.transform("x", lambda v, i: F.struct(i.alias("term"), v.alias("v"))), F.struct(F.lit(-1).alias("term"), F.lit(1.0).alias("v")))).alias("t"))
    slopes = slopes.groupBy(F.col("t.term").alias("term")).agg((F.sum(F.col("off") * F.col("t.v")) / F.sum("w")).alias("slope"))
    penalty = F.lit(float(model.getRegParam())) * F.col("coefficient")
    gradient = F.when(F.col("term") == -1, F.col("slope")).when(F.col("scale") > 0, F.col("slope") / F.col("scale") + penalty * F.col("scale")).otherwise(0.0)
    return fitted.join(slopes, "term").join(scales, "term", "left").select("term", "coefficient", gradient.alias("gradient"))


def compare_models(models: dict[tuple[str, str], Model], test: DataFrame) -> DataFrame:
    """One row of binary metrics per model, all computed in one pass over the scored rows."""
    by = ["learner", "treatment"]
    scored = freeze(
        reduce(
            DataFrame.unionByName,
            [
                score(model, test, []).withColumns({"learner": F.lit(learner), "treatment": F.lit(treatment)})
                for (learner, treatment), model in models.items()
            ],
        )
    )
    return metrics.binary_metrics(scored, by).join(metrics.auroc(scored, by=by), by)


class Rebalanced(Estimator):
    """Fits ``estimator`` on a rebalanced training set.

    Inside cross-validation the held-out side is thus never rebalanced, and no
    copies of a row can lie on both sides of a fold.
    """

    def __init__(self, estimator: Estimator, rebalance: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.estimator = estimator
        self.rebalance = rebalance

    def copy(self, extra=None) -> "Rebalanced":
        return Rebalanced(self.estimator.copy(extra), self.rebalance)

    def _fit(self, dataset: DataFrame) -> Model:
        return self.estimator.fit(self.rebalance(dataset))


# Rows of a training set that one task works on; fits of few rows are many short jobs, for which tasks cost more than rows.
FIT_ROWS = 100_000


def _few_parts(rows: DataFrame) -> DataFrame:
    """``rows`` as a table in as few parts as their number calls for."""
    stored = freeze(rows)
    return freeze(stored.coalesce(-(-stored.count() // FIT_ROWS) or 1))


def _refitted(learner: GBTClassifier, rows: DataFrame) -> Model:
    """``learner`` fitted on ``rows``: by the library, or grown by one task where many rows fit into it."""
    rounds, n_rows, n_features = learner.getMaxIter(), rows.count(), rows.select(F.size(vector_to_array("features"))).head()[0]
    if n_rows <= FIT_ROWS or boosting.bytes_held(n_rows, n_features, rounds) > boosting.TASK_BYTES:
        return learner.fit(rows)
    splits = boosting.candidate_splits(rows, learner.getSeed())
    trees = boosting.boost([rows], [splits], [learner.getSubsamplingRate()], [learner.getMaxDepth()], rounds, learner.getSeed(), leaves=True)
    return ensembles.boosted_model(learner, trees[0, 0, 0], splits, rows)


def tune_boosted_trees(
    train: DataFrame,
    keys: Sequence[str],
    sampling_rates: Sequence[float] = (0.25, 0.5, 0.75, 1.0),
    iterations: Sequence[int] = (20, 50, 100),
    depths: Sequence[int] = (3, 4, 5, 6),
    folds: int = 3,
    parallelism: int | None = None,
    seed: int = SEED,
) -> tuple[Model, DataFrame]:
    """The best model of a grid, refitted on all of ``train``, and the mean AUROC of each setting.

    Folds follow from the keys. Only the training side of a fold is up-sampled, so no copies of a row lie on both sides; it is
    written down once. A fit of the most rounds holds the fits of fewer, so each sampling rate and
    depth is fitted once a fold and scored at every number of rounds. All these fits grow side by side (``boosting.boost``), and the held-out rows
    are scored in one pass. ``parallelism`` evaluations share the cluster, two per core unless given.
    """
    spark = train.sparkSession
    folded = freeze(train.withColumn("fold", F.floor(draw(keys, "fold", seed) * folds).cast("int")))
    sides = [
        (
            _few_parts(sampling.upsample(folded.filter(F.col("fold") != i), "class", keys).select("features", "class")),
            _few_parts(folded.filter(F.col("fold") == i).select("features", "class")),
        )
        for i in range(folds)
    ]
    def learner(rate: float, rounds: int, depth: int) -> GBTClassifier:
        return boosted_trees(seed).setSubsamplingRate(rate).setMaxIter(rounds).setMaxDepth(depth)

    splits = [boosting.candidate_splits(fit_side, seed) for fit_side, _ in sides]
    trees = boosting.boost([fit_side for fit_side, _ in sides], splits, sampling_rates, depths, max(iterations), seed)
    lanes = [(r, d) for r in range(len(sampling_rates)) for d in range(len(depths))]

    def areas_of(fold: int) -> dict[str, float]:
        margins = boosting.staged_margins(sides[fold][1], splits[fold], [trees[fold, r, d] for r, d in lanes], iterations)
        return boosting.areas(freeze(margins))

    grid = [(rate, n, depth) for rate in sampling_rates for n in iterations for depth in depths]
    columns = [f"m{lanes.index((r, d))}_{n}" for r in range(len(sampling_rates)) for n in iterations for d in range(len(depths))]
    with ThreadPoolExecutor(parallelism or folds) as pool:
        areas = list(pool.map(inheritable_thread_target(spark)(areas_of), range(folds)))
    means = [sum(of_fold[c] for of_fold in areas) / folds for c in columns]
    best = grid[max(range(len(grid)), key=lambda i: means[i])]
    model = _refitted(learner(*best), _few_parts(sampling.upsample(train, "class", keys).select("features", "class")))
    settings = [(float(rate), n, depth, float(mean)) for (rate, n, depth), mean in zip(grid, means)]
    return model, spark.createDataFrame(settings, "sampling_rate double, iterations int, depth int, auroc double")
