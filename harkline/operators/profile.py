"""Counts, totals and distributions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from harkline.operators.frozen import freeze
from harkline.operators.running import running_total

# Columns whose aggregates stand side by side in one plan.
BLOCK_COLUMNS = 50


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(dataset, n_rows)``; a Parquet table answers from its footers."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("dataset"), "n_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """``(column, n_distinct)``, exact by default."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return (
        df.agg(*[count(c).alias(c) for c in columns])
        .unpivot([], list(columns), "column", "n_distinct")
    )


def group_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))


def total_plays(triplets: DataFrame, by: str) -> DataFrame:
    """Plays per song (popularity) or per user (activity)."""
    return triplets.groupBy(by).agg(F.sum("play_count").alias("total_plays"))


def most_active_user(triplets: DataFrame) -> DataFrame:
    """One row: the user with most plays, ties by id."""
    return total_plays(triplets, "user_id").orderBy(F.desc("total_plays"), "user_id").limit(1)


def most_active_rows(triplets: DataFrame) -> DataFrame:
    """The triplets of the most active user."""
    return triplets.filter(F.col("user_id") == most_active_user(triplets).select("user_id").scalar())


def top_user_share(triplets: DataFrame) -> DataFrame:
    """How much of the song catalogue the most active user has played."""
    songs = triplets.agg(F.countDistinct("song_id").alias("n")).scalar()
    return (
        most_active_rows(triplets)
        .agg(F.count(F.lit(1)).alias("n_songs"))
        .select("n_songs", songs.alias("n_catalogue"))
        .withColumn("percent", F.round(F.try_divide("n_songs", "n_catalogue") * 100, 6))
    )


def class_balance(df: DataFrame, label: str = "class", weight: str | None = None) -> DataFrame:
    """Rows per class and their share of all rows; with ``weight`` also the share of the weight."""
    sizes = {"count": F.count(F.lit(1))}
    if weight is not None:
        sizes["weight"] = F.sum(weight)
    counts = df.groupBy(label).agg(*[e.alias(n) for n, e in sizes.items()])
    for name, share in zip(sizes, ["ratio", "weight_ratio"]):
        total = counts.agg(F.sum(name).alias("total")).scalar()
        counts = counts.withColumn(share, F.round(F.col(name) / total, 3))
    return counts.orderBy(label)


def feature_summary(df: DataFrame, columns: Sequence[str], block_columns: int = BLOCK_COLUMNS) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column; all but the count are doubles.

    Columns are summarised in blocks, each of which reads its own columns only.
    """
    stats = {"n": F.count, "mean": F.mean, "stddev": F.stddev, "min": F.min, "max": F.max}

    def of(column: str) -> list[Column]:
        value = F.col(column).cast("double")
        return [function(value).alias(name) for name, function in stats.items()]

    columns = list(columns)
    parts = []
    for i in range(0, len(columns), block_columns):
        block = columns[i : i + block_columns]
        one_row = df.agg(*[F.struct(*of(c)).alias(c) for c in block])
        parts.append(one_row.unpivot([], block, "feature", "s").select("feature", "s.*"))
    return reduce(DataFrame.unionByName, parts)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins of a column between its extremes: ``(bin, low, high, n)``, bins from 1.

    The values are written down, as they are read for their extremes and for their bins; rows that a join has numbered could
    not be grouped by a subquery of themselves.
    """
    v = F.col(value)
    df = freeze(df.select(value).filter(v.isNotNull()))
    bounds = df.agg(F.struct(F.min(value).alias("lo"), (F.max(value) - F.min(value)).alias("span")).alias("b")).scalar()
    lo, span = bounds["lo"], bounds["span"]
    place = F.floor((v - lo) * bins / F.when(span == 0, 1).otherwise(span)) + 1
    return (
        df.groupBy(F.least(place, F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            F.round(lo + (F.col("bin") - 1) * span / bins, 6).alias("low"),
            F.round(lo + F.col("bin") * span / bins, 6).alias("high"),
            "n",
        )
    )


def density(df: DataFrame, value: str, points: int = 100) -> DataFrame:
    """``(x, density)``: a Gaussian kernel estimate at evenly spaced points.

    The bandwidth is the standard deviation times ``n ** -0.2``; the points reach half
    the span beyond both extremes. Equal values are counted first, and each task adds
    up its own share of every point, so only ``points`` sums per task are shuffled.
    """
    v = F.col(value)
    counts = freeze(df.filter(v.isNotNull()).groupBy(v.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    n, mean = F.sum("_n"), F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")
    shape = counts.agg(
        F.struct(
            n.alias("n"), mean.alias("mean"), F.min("_v").alias("lo"), (F.max("_v") - F.min("_v")).alias("span")
        ).alias("s")
    ).scalar()
    squares = F.sum(F.col("_n") * F.pow(F.col("_v") - shape["mean"], 2))
    width = counts.agg((F.sqrt(F.try_divide(squares, n - 1)) * F.pow(n, F.lit(-0.2))).alias("width")).scalar()
    x = shape["lo"] - shape["span"] / 2 + F.col("_i") * 2 * shape["span"] / (points - 1)
    kernel = F.exp(-F.pow(F.try_divide(x - F.col("_v"), width), 2) / 2)
    return (
        counts.select("_v", "_n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_i"))
        .groupBy("_i")
        .agg(F.sum(F.col("_n") * kernel).alias("_sum"))
        .select(x.alias("x"), F.try_divide("_sum", shape["n"] * width * F.sqrt(2 * F.pi())).alias("density"))
    )


def exact_percentiles(df: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """``(share, value)``, interpolated between neighbours, without holding all values in one task.

    Equal values are counted first; the places asked for are then found by a running
    count over the distinct values.
    """
    counts = freeze(df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n")))
    placed = running_total(counts, {"_upto": F.col("_n")}, [F.col(value).asc()])
    last = counts.agg((F.sum("_n") - 1).alias("last")).scalar()

    def holds(place):
        return (F.col("_upto") > place) & (F.col("_upto") - F.col("_n") <= place)

    wanted = []
    for share in shares:
        place = F.lit(float(share)) * F.col("_last")
        low, high = F.floor(place), F.ceil(place)
        part = place - low
        weight = F.when(holds(low), 1 - part).otherwise(0.0) + F.when(holds(high), part).otherwise(0.0)
        wanted.append(
            F.struct(F.lit(float(share)).alias("share"), weight.alias("weight"), (holds(low) | holds(high)).alias("used"))
        )
    return (
        placed.withColumn("_last", last)
        .select(value, F.explode(F.filter(F.array(*wanted), lambda w: w["used"])).alias("w"))
        .groupBy(F.col("w.share").alias("share"))
        .agg(F.sum(F.col(value) * F.col("w.weight")).alias("value"))
    )
