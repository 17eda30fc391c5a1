"""Ranking the scored rows of each user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from harkline.operators.running import rank_within


def ranked_items(scored: DataFrame, user: str, item: str, score: str) -> DataFrame:
    """``(user, position, item)`` by falling score, ties by item, for each user's whole list.

    The list stays in rows: one user may hold a large share of all of them.
    """
    ranked = rank_within(scored.select(user, item, score), "position", [F.desc(score), F.asc(item)], within=[user])
    return ranked.select(user, "position", item)


def top_k_items(scored: DataFrame, user: str, item: str, score: str, k: int) -> DataFrame:
    """``(user, position, item)`` of the ``k`` best items per user.

    Spark keeps only ``k`` rows per user on the map side of this filter, so a user
    with many rows is cut down before the shuffle.
    """
    best_first = Window.partitionBy(user).orderBy(F.desc(score), F.asc(item))
    return (
        scored.select(user, item, score)
        .withColumn("position", F.row_number().over(best_first))
        .filter(F.col("position") <= k)
        .select(user, "position", item)
    )
