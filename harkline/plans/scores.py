"""Metric queries over scores and lists that SQL can compute as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.operators import metrics, ranking
from harkline.plans import tables as t
from harkline.plans.models import triplet_sides
from harkline.plans.tables import Query, with_sql

K = 10
LISTED = 5


def binary_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as scored rows: the price is the score, returned lines are the positives."""
    price = F.col("l_extendedprice")
    return t.table(spark, sf, "lineitem").select(
        price.alias("score"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("class"),
        F.when(price > 50_000, 1).otherwise(0).alias("prediction"),
    )


def class_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines in three classes, with predictions of which one never occurs as a class."""
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    return t.table(spark, sf, "lineitem").select(
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("class"),
        F.when(quantity <= 12, 0).when(quantity <= 40, 1).otherwise(3).alias("prediction"),
        F.array(F.col("l_extendedprice"), quantity, F.col("l_discount")).alias("probability"),
    )


def popular_lists(train: DataFrame) -> DataFrame:
    """``(user_id, position, song_id)``: each training user is offered the most played songs."""
    popular = (
        train.groupBy("song_id").agg(F.sum("play_count").alias("plays")).orderBy(F.desc("plays"), "song_id").limit(LISTED)
    )
    falling = F.array_sort(F.collect_list(F.struct((-F.col("plays")).alias("falling"), "song_id")))
    songs = popular.agg(falling["song_id"].alias("songs")).scalar()
    listed = train.select("user_id").distinct().select("user_id", F.posexplode(songs).alias("at", "song_id"))
    return listed.select("user_id", (F.col("at") + 1).alias("position"), "song_id")


def relevant_items(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.ranked_items(triplet_sides(spark, sf)[1], "user_id", "song_id", "play_count")


def ranked_items(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.ranked_items(t.clean_triplets(spark, sf), "user_id", "song_id", "play_count")


def top_k_items(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_k_items(t.clean_triplets(spark, sf), "user_id", "song_id", "play_count", LISTED)


def list_metric(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        train, test = triplet_sides(spark, sf)
        scored = metrics.ranking_metrics(popular_lists(train), test, K)
        return scored.select("n_users", F.round(name, 9).alias(name))

    return run


_LIST_METRICS = ["precision_at_k", "ndcg_at_k", "map_at_k"]


def list_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """All three metrics of the same lists at once."""
    train, test = triplet_sides(spark, sf)
    return metrics.ranking_metrics(popular_lists(train), test, K).select("n_users", *[rounded(m) for m in _LIST_METRICS])


def rounded(name: str, digits: int = 9):
    return F.round(name, digits).alias(name)


def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = metrics.binary_metrics(binary_scores(spark, sf))
    return scored.select(
        "total", "pos_actual", "neg_actual", "pos_pred", "neg_pred", "tp", "fp", "fn", "tn",
        *[rounded(m) for m in ["precision", "recall", "accuracy"]],
    )


def multiclass_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = metrics.multiclass_metrics(class_scores(spark, sf))
    return scored.select(
        "class", "num_actual", "num_pred", "correct_pred", *[rounded(m) for m in ["precision", "recall", "accuracy"]]
    )


_BINARY = {
    "scored": """SELECT l_extendedprice AS score, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS class,
        CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS prediction FROM lineitem""",
}
_CLASSES = {
    "scored": """SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS class,
        CASE WHEN l_quantity <= 12 THEN 0 WHEN l_quantity <= 40 THEN 1 ELSE 3 END AS prediction,
        l_extendedprice AS s0, l_quantity AS s1, l_discount AS s2 FROM lineitem""",
    "ids": "SELECT class FROM scored UNION SELECT prediction FROM scored",
    "per_class": """SELECT i.class, count(*) FILTER (s.class = i.class) AS num_actual,
        count(*) FILTER (s.prediction = i.class) AS num_pred,
        count(*) FILTER (s.class = i.class AND s.prediction = i.class) AS correct_pred,
        count(*) FILTER (s.class <> i.class AND s.prediction <> i.class) AS tn, count(*) AS total
        FROM ids i JOIN scored s ON true GROUP BY i.class""",
}


def _auroc_sql(score: str, positive: str) -> str:
    """Rank-sum form, with the mean rank for ties."""
    return f"""SELECT (sum(r) FILTER (pos) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2.0::DOUBLE)
        / (count(*) FILTER (pos)::DOUBLE * count(*) FILTER (NOT pos)) AS auroc FROM (
        SELECT {positive} AS pos, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE AS r
        FROM scored)"""


_LISTS = {
    "popular": f"""SELECT song_id, row_number() OVER (ORDER BY sum(play_count) DESC, song_id) AS position FROM train
        GROUP BY song_id ORDER BY position LIMIT {LISTED}""",
    "lists": "SELECT user_id, position, song_id FROM (SELECT DISTINCT user_id FROM train) JOIN popular ON true",
    "sizes": "SELECT user_id, count(*) AS n_relevant FROM test GROUP BY user_id",
    "hits": """SELECT l.user_id, position, CASE WHEN t.song_id IS NULL THEN 0 ELSE 1 END AS hit, n_relevant
        FROM lists l JOIN sizes USING (user_id) LEFT JOIN test t ON l.user_id = t.user_id AND l.song_id = t.song_id""",
    "counted": """SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY position) AS so_far FROM hits""",
    "per_user": f"""SELECT user_id, sum(hit) / {K}::DOUBLE AS precision_at_k,
        sum(hit / log2(position + 1)) / list_sum(list_transform(range(1, least(any_value(n_relevant), {K}) + 1),
            lambda i: 1 / log2(i + 1))) AS ndcg_at_k,
        sum(hit * so_far / position::DOUBLE) / least(any_value(n_relevant), {K}) AS map_at_k
        FROM counted GROUP BY user_id""",
}


def _list_sql(name: str) -> str:
    return with_sql(f"SELECT count(*) AS n_users, round(avg({name}), 9) AS {name} FROM per_user", **_LISTS)


def _ranking_sql(source: str) -> str:
    return with_sql(f"""SELECT user_id, song_id, CAST(row_number() OVER (PARTITION BY user_id
        ORDER BY play_count DESC, song_id) AS BIGINT) AS position FROM {source}""")


QUERIES = {
    "confusion_matrix": Query(
        lambda spark, sf: metrics.confusion_matrix(binary_scores(spark, sf)),
        with_sql("SELECT class, prediction, count(*) AS n FROM scored GROUP BY class, prediction", **_BINARY),
    ),
    "binary_metrics": Query(
        binary_metrics,
        with_sql(
            """SELECT *, round(tp / pos_pred::DOUBLE, 9) AS precision, round(tp / pos_actual::DOUBLE, 9) AS recall,
                round((tp + tn) / total::DOUBLE, 9) AS accuracy FROM counts""",
            **_BINARY,
            counts="""SELECT count(*) AS total,
                count(*) FILTER (class = 1) AS pos_actual, count(*) FILTER (class = 0) AS neg_actual,
                count(*) FILTER (prediction = 1) AS pos_pred, count(*) FILTER (prediction = 0) AS neg_pred,
                count(*) FILTER (prediction = 1 AND class = 1) AS tp, count(*) FILTER (prediction = 1 AND class = 0) AS fp,
                count(*) FILTER (prediction = 0 AND class = 1) AS fn, count(*) FILTER (prediction = 0 AND class = 0) AS tn
                FROM scored""",
        ),
    ),
    "auroc": Query(
        lambda spark, sf: metrics.auroc(binary_scores(spark, sf)).select(rounded("auroc")),
        with_sql("SELECT round(auroc, 9) AS auroc FROM area", **_BINARY, area=_auroc_sql("score", "class = 1")),
    ),
    "multiclass_metrics": Query(
        multiclass_metrics,
        with_sql(
            """SELECT class, num_actual, num_pred, correct_pred,
                CASE WHEN num_pred = 0 THEN 'NaN'::DOUBLE ELSE round(correct_pred / num_pred::DOUBLE, 9) END AS precision,
                CASE WHEN num_actual = 0 THEN 'NaN'::DOUBLE ELSE round(correct_pred / num_actual::DOUBLE, 9) END AS recall,
                round((correct_pred + tn) / total::DOUBLE, 9) AS accuracy FROM per_class""",
            **_CLASSES,
        ),
    ),
    "ovr_auroc": Query(
        lambda spark, sf: metrics.ovr_auroc(class_scores(spark, sf)).select("class", rounded("auroc")),
        with_sql(
            " UNION ALL ".join(f"SELECT {c} AS class, round(auroc, 9) AS auroc FROM area{c}" for c in range(3)),
            **_CLASSES,
            **{f"area{c}": _auroc_sql(f"s{c}", f"class = {c}") for c in range(3)},
        ),
    ),
    "macro_auroc": Query(
        lambda spark, sf: metrics.macro_auroc(metrics.ovr_auroc(class_scores(spark, sf))).select("n_classes", rounded("macro_auroc")),
        with_sql(
            f"SELECT count(*) AS n_classes, round(avg(auroc), 9) AS macro_auroc FROM ({' UNION ALL '.join(f'SELECT auroc FROM area{c}' for c in range(3))})",
            **_CLASSES,
            **{f"area{c}": _auroc_sql(f"s{c}", f"class = {c}") for c in range(3)},
        ),
    ),
    "ranked_items": Query(ranked_items, _ranking_sql("clean_triplets")),
    "top_k_items": Query(
        top_k_items,
        with_sql(f"""SELECT user_id, song_id, position FROM (SELECT user_id, song_id, CAST(row_number() OVER (
            PARTITION BY user_id ORDER BY play_count DESC, song_id) AS INTEGER) AS position FROM clean_triplets)
            WHERE position <= {LISTED}"""),
    ),
    "relevant_items": Query(relevant_items, _ranking_sql("test")),
    "list_metrics": Query(
        list_metrics,
        with_sql(
            f"SELECT count(*) AS n_users, {', '.join(f'round(avg({m}), 9) AS {m}' for m in _LIST_METRICS)} FROM per_user", **_LISTS
        ),
    ),
    "precision_at_k": Query(list_metric("precision_at_k"), _list_sql("precision_at_k")),
    "ndcg_at_k": Query(list_metric("ndcg_at_k"), _list_sql("ndcg_at_k")),
    "map_at_k": Query(list_metric("map_at_k"), _list_sql("map_at_k")),
}
