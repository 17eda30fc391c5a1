"""Classification and ranking metrics, for any number of models at once.

``by`` names grouping columns (such as the model), so that one pass scores them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from harkline.operators.running import running_total


def _ratio(part: Column, whole: Column) -> Column:
    """NaN where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(float("nan"))).otherwise(part / whole)


def confusion_matrix(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, class, prediction, n)``."""
    return predictions.groupBy(*by, "class", "prediction").agg(F.count(F.lit(1)).alias("n"))


def binary_counts(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, predicted and actual sizes, and the four outcomes."""
    def rows(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    actual, predicted = F.col("class") == 1, F.col("prediction") == 1
    return confusion.groupBy(*by).agg(
        F.sum("n").alias("total"),
        rows(actual).alias("pos_actual"),
        rows(~actual).alias("neg_actual"),
        rows(predicted).alias("pos_pred"),
        rows(~predicted).alias("neg_pred"),
        rows(predicted & actual).alias("tp"),
        rows(predicted & ~actual).alias("fp"),
        rows(~predicted & actual).alias("fn"),
        rows(~predicted & ~actual).alias("tn"),
    )


def binary_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = binary_counts(confusion_matrix(predictions, by), by)
    tp, tn = F.col("tp"), F.col("tn")
    return counts.select(
        *counts.columns,
        _ratio(tp, F.col("pos_pred")).alias("precision"),
        _ratio(tp, F.col("pos_actual")).alias("recall"),
        _ratio(tp + tn, F.col("total")).alias("accuracy"),
    )


def auroc(scored: DataFrame, score: str = "score", label: str = "class", by: Sequence[str] = ()) -> DataFrame:
    """``(*by, auroc)``: exact area under the ROC curve, tied scores counting half.

    Equal scores are counted first. A positive beats the negatives scored below it,
    which a running count over the distinct scores tells.
    """
    positive = F.col(label) == 1
    counts = scored.groupBy(*by, score).agg(F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg"))
    placed = running_total(counts, {"_neg_upto": F.col("_neg")}, [F.col(score).asc()], within=by)
    beaten = (F.col("_neg_upto") - F.col("_neg") / 2) * F.col("_pos")
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return placed.groupBy(*by).agg(_ratio(F.sum(beaten), pairs).alias("auroc"))


def multiclass_metrics(predictions: DataFrame) -> DataFrame:
    """One row per class that occurs or is predicted, each against the rest."""
    counts = confusion_matrix(predictions).select(F.col("class").cast("int"), F.col("prediction").cast("int"), "n")
    # Each cell counts for its class and for its prediction, so one roll-up serves both.
    sides = F.array(
        F.struct(F.col("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("class") == F.col("prediction"), F.col("n")).otherwise(0)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    per_class = (
        counts.select(F.inline(F.transform(sides, lambda s: s.withField("hit", hit))))
        .groupBy("class")
        .agg(
            F.sum("actual").alias("num_actual"),
            F.sum("predicted").alias("num_pred"),
            # A hit stands on both sides of its cell.
            (F.sum("hit") / 2).cast("long").alias("correct_pred"),
        )
    )
    actual, predicted, correct = F.col("num_actual"), F.col("num_pred"), F.col("correct_pred")
    return per_class.select(
        "*",
        _ratio(correct, predicted).alias("precision"),
        _ratio(correct, actual).alias("recall"),
        _ratio(total - actual - predicted + 2 * correct, total).alias("accuracy"),
    )


def ovr_auroc(scored: DataFrame, scores: str = "probability", label: str = "class") -> DataFrame:
    """``(class, auroc)`` of each class against the rest, from an array with a score per class."""
    long = scored.select(F.col(label).cast("int").alias("_actual"), F.posexplode(scores).alias("class", "score"))
    long = long.withColumn("_hit", F.when(F.col("_actual") == F.col("class"), 1).otherwise(0))
    return auroc(long, "score", "_hit", by=["class"])


def macro_auroc(per_class: DataFrame) -> DataFrame:
    """One row: the plain mean over the classes that have an AUROC, and how many have one."""
    known = per_class.filter(F.col("auroc").isNotNull() & ~F.isnan("auroc"))
    return known.agg(F.count(F.lit(1)).alias("n_classes"), F.avg("auroc").alias("macro_auroc"))


def ranking_per_user(
    recommended: DataFrame, relevant: DataFrame, k: int, user: str = "user_id", item: str = "song_id"
) -> DataFrame:
    """``(user, precision, ndcg, average_precision)`` at ``k``.

    ``recommended`` is ``(user, position, item)`` with positions from 1, ``relevant``
    is ``(user, item)``. Users without rows on both sides do not count.
    """
    relevant = relevant.select(user, item).distinct()
    considered = recommended.filter(F.col("position") <= k).select(user, item, "position")
    flagged = considered.join(relevant.withColumn("_hit", F.lit(1)), [user, item], "left")
    # At most k rows per user are left here.
    so_far = Window.partitionBy(user).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.coalesce(F.col("_hit"), F.lit(0))
    position = F.col("position")
    gains = (
        flagged.withColumn("_hits", F.sum(hit).over(so_far))
        .groupBy(user)
        .agg(
            F.sum(hit).alias("_n_hits"),
            F.sum(F.when(hit == 1, 1 / F.log2(position + 1)).otherwise(0.0)).alias("_gain"),
            F.sum(F.when(hit == 1, F.col("_hits") / position).otherwise(0.0)).alias("_precisions"),
        )
    )
    wanted = F.least(F.col("_n_relevant"), F.lit(k)).cast("int")
    ideal = F.aggregate(F.sequence(F.lit(1), wanted), F.lit(0.0), lambda total, i: total + 1 / F.log2(i + 1))
    sizes = relevant.groupBy(user).agg(F.count(F.lit(1)).alias("_n_relevant"))
    return gains.join(sizes, user).select(
        user,
        (F.col("_n_hits") / k).alias("precision"),
        (F.col("_gain") / ideal).alias("ndcg"),
        (F.col("_precisions") / wanted).alias("average_precision"),
    )


def ranking_metrics(
    recommended: DataFrame, relevant: DataFrame, k: int, user: str = "user_id", item: str = "song_id"
) -> DataFrame:
    """One row: users, precision, NDCG and mean average precision at ``k``."""
    per_user = ranking_per_user(recommended, relevant, k, user, item)
    return per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.avg("precision").alias("precision_at_k"),
        F.avg("ndcg").alias("ndcg_at_k"),
        F.avg("average_precision").alias("map_at_k"),
    )
