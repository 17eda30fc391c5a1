"""Queries that fit and score models. Each session fits a model once per data folder."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from harkline.operators import classify, ensembles, features, metrics, sampling
from harkline.operators.frozen import freeze
from harkline.operators.recommend import Recommender, fit_recommender
from harkline.plans import splits, tables as t
from harkline.plans.splits import KEY
from harkline.plans.tables import FEATURES, Query

K = 5


@lru_cache(maxsize=4)
def binary_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return _sides(splits.binary_split(spark, sf))


@lru_cache(maxsize=4)
def genre_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return _sides(splits.genre_split(spark, sf))


def _sides(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    vectors = freeze(features.assemble(split, FEATURES))
    return sampling.training(vectors), sampling.holdout(vectors)


def scored(learner: str, treatment: str = "plain"):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        train, test = binary_sides(spark, sf)
        treated = train if treatment == "plain" else freeze(classify.TREATMENTS[treatment](train, KEY))
        return classify.score(classify.LEARNERS[learner]().fit(treated), test, KEY)

    return run


def lr_weighted_predictions(spark: SparkSession, sf: str) -> DataFrame:
    train, test = binary_sides(spark, sf)
    model = classify.logistic_regression("weight").fit(sampling.class_weight(train, "class"))
    return classify.score(model, test, KEY)


@lru_cache(maxsize=4)
def genre_forest(spark: SparkSession, sf: str) -> Model:
    return classify.random_forest().fit(genre_sides(spark, sf)[0])


def rf_multiclass(spark: SparkSession, sf: str) -> DataFrame:
    return classify.score_classes(genre_forest(spark, sf), genre_sides(spark, sf)[1], KEY)


def rf_multiclass_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rf_multiclass(spark, sf).select("track_id", "class", "prediction", F.array_max("probability").alias("confidence"))


def rf_multiclass_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Per-class metrics of the forest, with the AUROC of each class against the rest."""
    predictions = freeze(rf_multiclass(spark, sf))
    areas = freeze(metrics.ovr_auroc(predictions))
    macro = metrics.macro_auroc(areas).select("macro_auroc").scalar()
    return metrics.multiclass_metrics(predictions).join(areas, "class", "left").withColumn("macro_auroc", macro)


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    train, test = binary_sides(spark, sf)
    return classify.compare_models(classify.fit_all(train, KEY), test)


@lru_cache(maxsize=4)
def tuned(spark: SparkSession, sf: str) -> tuple[Model, DataFrame]:
    """The full grid of ``tune_boosted_trees``, searched once for both queries."""
    return classify.tune_boosted_trees(binary_sides(spark, sf)[0], KEY)


def cv_grid(spark: SparkSession, sf: str) -> DataFrame:
    return tuned(spark, sf)[1]


def tuned_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics on the test side of the best model of the grid."""
    return classify.compare_models({("boosted trees", "tuned"): tuned(spark, sf)[0]}, binary_sides(spark, sf)[1])


@lru_cache(maxsize=4)
def split_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return freeze(splits.triplet_split(spark, sf))


def train_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.training(split_triplets(spark, sf))


@lru_cache(maxsize=4)
def test_triplets(spark: SparkSession, sf: str) -> DataFrame:
    """Test triplets of users who occur in training; only queries that use them have them written."""
    split = split_triplets(spark, sf)
    return freeze(sampling.warm_users(sampling.holdout(split), sampling.training(split), stored=True))


def triplet_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return train_triplets(spark, sf), test_triplets(spark, sf)


@lru_cache(maxsize=4)
def recommender(spark: SparkSession, sf: str) -> Recommender:
    return fit_recommender(train_triplets(spark, sf))


def id_index(spark: SparkSession, sf: str) -> DataFrame:
    """Index of the users and songs of the training triplets."""
    train = train_triplets(spark, sf)
    indexes = [
        features.frequency_index(train, column, "index").select(
            F.lit(column).alias("kind"), F.col(column).alias("name"), "n_rows", "index"
        )
        for column in ["user_id", "song_id"]
    ]
    return indexes[0].unionByName(indexes[1])


def test_index(spark: SparkSession, sf: str) -> DataFrame:
    """Test triplets under the training index."""
    train, test = train_triplets(spark, sf), test_triplets(spark, sf)
    users = freeze(features.frequency_index(train, "user_id", "user_int"))
    songs = freeze(features.frequency_index(train, "song_id", "song_int"))
    indexed = features.apply_index(features.apply_index(test, users, "user_id"), songs, "song_id")
    return indexed.select("user_id", "song_id", "play_count", "user_int", "song_int")


def als_factors(spark: SparkSession, sf: str) -> DataFrame:
    return recommender(spark, sf).factors().select("kind", "name", F.posexplode("features").alias("at", "value"))


def recommendation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Precision, NDCG and mean average precision of the songs recommended to the users of the test side."""
    test = test_triplets(spark, sf)
    return metrics.ranking_metrics(recommender(spark, sf).recommend(K, test), test, K)


# What outputs of fitted models promise, whatever the fit: who and what they cover. SQL says the same from the split.


def model_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the test side by class, from the scores of three learners."""
    runs = {"logistic regression": "plain", "random forest": "downsampled", "boosted trees": "plain"}
    parts = []
    for learner, treatment in runs.items():
        rows = scored(learner, treatment)(spark, sf)
        parts.append(rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isin(0, 1)).alias("n_predicted")).select(F.lit(learner).alias("learner"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def factor_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return recommender(spark, sf).factors().select("kind", "name", F.size("features").alias("rank"))


def recommendation_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """For each user, how many songs are listed, how many different ones, and how many are rated above the one before."""
    before = F.lag("rating").over(Window.partitionBy("user_id").orderBy("position"))
    rows = recommender(spark, sf).recommend(K).withColumn("rising", (F.col("rating") > before).cast("int"))
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("song_id").alias("n_songs"), F.coalesce(F.sum("rising"), F.lit(0)).alias("n_rising")
    )


def unplayed_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """For each user, how many songs are listed when those played in training are left out, and how many of them were played."""
    train = train_triplets(spark, sf)
    rows = recommender(spark, sf).recommend_unplayed(train, K)
    played = train.select("user_id", "song_id", F.lit(1).alias("played"))
    return rows.join(played, ["user_id", "song_id"], "left").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count("played").alias("n_played"))


# What fitted values must satisfy, whatever the data: SQL says that all of them do.


@lru_cache(maxsize=4)
def logistic_model(spark: SparkSession, sf: str, weighted: bool) -> Model:
    train, _ = binary_sides(spark, sf)
    rows = sampling.class_weight(train, "class") if weighted else train
    # Far more rounds than the fit of the comparison, so that it ends at the optimum.
    return classify.logistic_regression("weight" if weighted else None).setMaxIter(200).setTol(1e-12).fit(rows)


def lr_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the loss is flat at the coefficients of a plain and a weighted logistic regression."""
    train, _ = binary_sides(spark, sf)
    weighted = sampling.class_weight(train, "class")
    parts = [("plain", classify.loss_gradient(logistic_model(spark, sf, False), train)), ("weighted", classify.loss_gradient(logistic_model(spark, sf, True), weighted, "weight"))]
    flat = [df.select(F.lit(name).alias("treatment"), "term", (F.abs("gradient") < 1e-5).alias("flat")) for name, df in parts]
    return flat[0].unionByName(flat[1])


def tree_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the test side, and those scored alike by the table of a model's trees and the model."""
    train, test = binary_sides(spark, sf)
    parts = []
    for learner in ["random forest", "boosted trees"]:
        model = classify.LEARNERS[learner]().fit(train)
        leaves = ensembles.leaves_reached(ensembles.tree_table(model), test, KEY)
        if learner == "boosted trees":
            ours, theirs = ensembles.boosted_margin(leaves, KEY).withColumnRenamed("margin", "ours"), classify.score(model, test, KEY)
        else:
            ours = ensembles.forest_votes(leaves, KEY).filter("at = 1").withColumnRenamed("share", "ours")
            theirs = classify.score_classes(model, test, KEY).withColumn("score", F.col("probability")[1])
        same = F.abs(F.col("ours") - F.col("score")) < 1e-9
        parts.append(ours.join(theirs, KEY).agg(F.lit(learner).alias("learner"), F.count(F.lit(1)).alias("n"), F.count_if(same).alias("n_same")))
    return parts[0].unionByName(parts[1])


def boosted_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """For each boosting round, the training rows in its leaves, and whether all leaves hold the mean of what the round fitted."""
    train, _ = binary_sides(spark, sf)
    errors = ensembles.leaf_errors(ensembles.tree_table(classify.boosted_trees().fit(train)), train, KEY)
    right = F.abs(F.col("value") - F.col("expected")) < 1e-9
    return errors.groupBy("tree").agg(F.sum("n_rows").alias("n"), F.bool_and(right).alias("all_right"))


def als_residual(spark: SparkSession, sf: str) -> DataFrame:
    """For each user, songs played in training, and whether the factors solve the user's normal equations."""
    rows = recommender(spark, sf).residuals(train_triplets(spark, sf))
    return rows.select("user_id", "n_songs", (F.col("residual") < 1e-3).alias("solved"))


def sampled_users(spark: SparkSession, sf: str) -> DataFrame:
    """The drawn users and how many of their test rows are scored."""
    rows = recommender(spark, sf).sampled_user_scores(test_triplets(spark, sf))
    return rows.groupBy("user_id").agg(F.count("prediction").alias("n_rows"))


def forget() -> None:
    """Drops the models and tables kept for the session, so that the next query fits anew."""
    for kept in [binary_sides, genre_sides, genre_forest, tuned, split_triplets, test_triplets, recommender, logistic_model]:
        kept.cache_clear()


_INDEX_SQL = """SELECT {column} AS name, count(*) AS n_rows,
    CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INTEGER) AS index FROM train GROUP BY {column}"""
_INDEXES = {
    "user_index": _INDEX_SQL.format(column="user_id"),
    "song_index": _INDEX_SQL.format(column="song_id"),
}

QUERIES = {
    "lr_predictions": Query(scored("logistic regression")),
    "lr_downsampled_predictions": Query(scored("logistic regression", "downsampled")),
    "lr_upsampled_predictions": Query(scored("logistic regression", "upsampled")),
    "lr_weighted_predictions": Query(lr_weighted_predictions),
    "rf_predictions": Query(scored("random forest")),
    "gbt_predictions": Query(scored("boosted trees")),
    "rf_multiclass_predictions": Query(rf_multiclass_predictions),
    "rf_multiclass_metrics": Query(rf_multiclass_metrics),
    "model_comparison": Query(model_comparison),
    "cv_grid": Query(cv_grid),
    "tuned_metrics": Query(tuned_metrics),
    "id_index": Query(
        id_index,
        t.with_sql(
            """SELECT 'user_id' AS kind, name, n_rows, index FROM user_index
                UNION ALL SELECT 'song_id', name, n_rows, index FROM song_index""",
            **_INDEXES,
        ),
    ),
    "test_index": Query(
        test_index,
        t.with_sql(
            """SELECT user_id, song_id, play_count, u.index AS user_int, s.index AS song_int
                FROM test JOIN user_index u ON user_id = u.name JOIN song_index s ON song_id = s.name""",
            **_INDEXES,
        ),
    ),
    "als_factors": Query(als_factors),
    "user_recommendations": Query(lambda spark, sf: recommender(spark, sf).recommend(K)),
    "recommended_items": Query(lambda spark, sf: recommender(spark, sf).recommended_items(K)),
    "sampled_user_scores": Query(
        lambda spark, sf: recommender(spark, sf).sampled_user_scores(test_triplets(spark, sf))
    ),
    "recommendation_metrics": Query(recommendation_metrics),
    "model_coverage": Query(
        model_coverage,
        t.with_sql(
            """SELECT learner, class, count(*) AS n, count(*) AS n_predicted FROM split
                JOIN (VALUES ('logistic regression'), ('random forest'), ('boosted trees')) AS l(learner) ON true
                WHERE NOT in_train GROUP BY learner, class""",
            **splits.SPLIT_SQL,
        ),
    ),
    "factor_coverage": Query(
        factor_coverage,
        t.with_sql(
            """SELECT DISTINCT 'user' AS kind, user_id AS name, 10 AS rank FROM train
                UNION ALL SELECT DISTINCT 'song', song_id, 10 FROM train"""
        ),
    ),
    "recommendation_coverage": Query(
        recommendation_coverage,
        t.with_sql(f"SELECT DISTINCT user_id, {K}::BIGINT AS n, {K}::BIGINT AS n_songs, 0::BIGINT AS n_rising FROM train"),
    ),
    "unplayed_coverage": Query(
        unplayed_coverage,
        t.with_sql(
            f"""SELECT user_id, least({K}, (SELECT count(DISTINCT song_id) FROM train) - count(*)) AS n, 0::BIGINT AS n_played
                FROM train GROUP BY user_id"""
        ),
    ),
    "lr_optimality": Query(
        lr_optimality,
        f"""SELECT treatment, CAST(term AS INTEGER) AS term, true AS flat
            FROM (VALUES ('plain'), ('weighted')) AS t(treatment), range(-1, {len(FEATURES)}) AS r(term)""",
    ),
    "tree_scores": Query(
        tree_scores,
        t.with_sql(
            """SELECT learner, count(*) AS n, count(*) AS n_same FROM split
                JOIN (VALUES ('random forest'), ('boosted trees')) AS l(learner) ON true WHERE NOT in_train GROUP BY learner""",
            **splits.SPLIT_SQL,
        ),
    ),
    "boosted_leaves": Query(
        boosted_leaves,
        t.with_sql(
            "SELECT CAST(tree AS INTEGER) AS tree, count(*) AS n, true AS all_right FROM training, range(20) AS r(tree) GROUP BY tree",
            **splits.SPLIT_SQL,
        ),
    ),
    "als_residual": Query(
        als_residual,
        t.with_sql("SELECT user_id, count(*) AS n_songs, true AS solved FROM train GROUP BY user_id"),
    ),
    "sampled_users": Query(
        sampled_users,
        t.with_sql(
            f"""SELECT user_id, count(*) AS n_rows FROM test WHERE song_id IN (SELECT song_id FROM train) AND user_id IN (
                SELECT user_id FROM (SELECT DISTINCT user_id FROM test) ORDER BY {splits._bits_sql('sample', 'user_id')}, user_id LIMIT 10)
                GROUP BY user_id"""
        ),
    ),
}
