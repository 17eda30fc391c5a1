"""Repeatable splits, re-balancing and shuffling.

``keys`` name the columns that identify a row. All draws follow from them.
"""

from __future__ import annotations

from functools import reduce

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from harkline.functions.draws import SEED, draw, draw_bits
from harkline.operators.frozen import freeze
from harkline.operators.joins import lookup_join
from harkline.operators.running import rank_within

# The draws of a class fall into 2^16 equal ranges, told apart by their upper bits.
RANGE_BITS = 16


def class_row_number(df: DataFrame, label: str, keys: Sequence[str], salt: str = "split", seed: int = SEED) -> DataFrame:
    """Adds ``row``: a random rank, from 1, inside each class."""
    drawn = df.withColumn("_bits", draw_bits(keys, salt, seed))
    ranked = rank_within(drawn, "row", [F.col("_bits").asc(), *[F.col(k).asc() for k in keys]], within=[label])
    return ranked.drop("_bits")


def _cuts(df: DataFrame, label: str, keys: list[str], fraction: float, salt: str, seed: int) -> DataFrame:
    """Where each class is cut: ``(label, _cut)``, one row per class.

    Rows are in up to the draw and key of ``_cut``. Rows whose draw lies in a lower
    range are all in, so only rows of the range with the cut need to be put in order.
    """
    bits = draw_bits(keys, salt, seed)
    slim = df.select(label, *keys, bits.alias("_bits")).withColumn("_range", F.shiftright("_bits", RANGE_BITS))

    of_class = Window.partitionBy(label)
    counted = slim.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("_n"))
    taken = F.ceil(F.sum("_n").over(of_class) * F.lit(float(fraction))) - 1
    upto = F.sum("_n").over(of_class.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0))
    edge = freeze(
        counted.select(label, "_range", (upto - F.col("_n")).alias("_before"), upto.alias("_upto"), taken.alias("_taken"))
        .filter((F.col("_before") <= F.col("_taken")) & (F.col("_taken") < F.col("_upto")))
        .select(label, "_range", (F.col("_taken") - F.col("_before")).alias("_left"))
    )

    inside = lookup_join(slim, edge, [label, "_range"], "inner", stored=True).groupBy(label, "_left", "_bits", *keys).agg(
        F.count(F.lit(1)).alias("_n")
    )
    in_order = of_class.orderBy("_bits", *keys).rowsBetween(Window.unboundedPreceding, 0)
    last = (
        inside.withColumn("_row", F.sum("_n").over(in_order))
        .filter(F.col("_row") <= F.col("_left"))
        .groupBy(label)
        .agg(F.max(F.struct("_bits", *keys)).alias("_cut"))
    )
    # Nulls come first in the order of structs: this lies just before the range's first row.
    no_key = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
    start = F.struct(F.shiftleft("_range", RANGE_BITS).alias("_bits"), *no_key)
    return edge.join(last, label, "left").select(label, F.coalesce("_cut", start).alias("_cut"))


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], fraction: float = 0.8, salt: str = "split", seed: int = SEED
) -> DataFrame:
    """Adds ``in_train``: per class, true for random ranks strictly below ``fraction`` of the class size.

    Works for any number of classes, and gives a class of n rows ``ceil(n * fraction) - 1``
    training rows. The rows themselves are neither sorted nor shuffled, however
    large a class is: two passes over label and key find the cut of each class, and
    a row is compared with the cut of its class. Rows that share a key stay on one
    side. ``df`` is read three times, so freeze it first if it is costly to compute.
    """
    keys = list(keys)
    cut = lookup_join(df, _cuts(df, label, keys, fraction, salt, seed), label, "left")
    own = F.struct(draw_bits(keys, salt, seed).alias("_bits"), *keys)
    return cut.select(*df.columns, F.coalesce(own <= F.col("_cut"), F.lit(False)).alias("in_train"))


def training(split: DataFrame) -> DataFrame:
    return split.filter("in_train").drop("in_train")


def holdout(split: DataFrame) -> DataFrame:
    """The rows that are not for training: the same predicate, negated, so the sides cannot overlap."""
    return split.filter("NOT in_train").drop("in_train")


def holdout_of_tables(everything: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """The complement when the training set is given as a table."""
    return lookup_join(everything, train.select(key).distinct(), key, "left_anti")


def downsample(
    df: DataFrame, label: str, keys: Sequence[str], negatives_per_positive: float = 3.0, salt: str = "down", seed: int = SEED
) -> DataFrame:
    """Keeps all of class 1 and about that many rows of class 0 for each."""
    is_negative = F.col(label) == 0
    positives, negatives = F.count_if(F.col(label) == 1), F.count_if(is_negative)
    keep = df.agg(F.try_divide(negatives_per_positive * positives, negatives).alias("keep")).scalar()
    return df.filter(~is_negative | (draw(keys, salt, seed) < keep))


def upsample(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    tries: int = 10,
    drop_share: float = 0.75,
    min_copies: int = 0,
    salt: str = "up",
    seed: int = SEED,
) -> DataFrame:
    """Repeats each row of class 1 as often as ``tries`` draws exceed ``drop_share``; class 0 stays.

    The number of copies is Binomial(tries, 1 - drop_share), so a row may vanish
    unless ``min_copies`` is set.
    """
    draws = [draw(keys, salt, seed, F.lit(str(i))) for i in range(1, tries + 1)]
    copies = sum((F.when(d > drop_share, 1).otherwise(0) for d in draws), F.lit(0))
    times = F.when(F.col(label) == 1, F.greatest(copies, F.lit(min_copies))).otherwise(1)
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy")


def class_weight(df: DataFrame, label: str, positive: float = 1.5, other: float = 1.0) -> DataFrame:
    """Adds ``weight``."""
    return df.withColumn("weight", F.when(F.col(label) == 1, positive).otherwise(other))


def random_split(
    df: DataFrame, keys: Sequence[str], fraction: float = 0.7, salt: str = "triplet", seed: int = SEED
) -> DataFrame:
    """Adds ``in_train``, true for about ``fraction`` of the rows."""
    return df.withColumn("in_train", draw(keys, salt, seed) < fraction)


def split_report(split: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """``(part, n_rows, n_users)`` of a random split: training, holdout, the holdout rows of users and of songs
    that training has, and those of users it has and songs it does not, which no model can score."""
    train, held_out = training(split), holdout(split)
    warm = warm_users(held_out, train)
    known = lookup_join(warm, train.select(item).distinct(), item, "left_semi")
    unseen = lookup_join(warm, train.select(item).distinct(), item, "left_anti")
    parts = {"training": train, "holdout": held_out, "warm": warm, "scorable": known, "unseen_songs": unseen}
    rows = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(user).alias("n_users")).select(F.lit(n).alias("part"), "*") for n, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def warm_users(test: DataFrame, train: DataFrame, stored: bool = False) -> DataFrame:
    """Test rows of users that occur in training; ``stored`` if ``test`` is a table, or a plain scan of one."""
    return lookup_join(test, train.select("user_id").distinct(), "user_id", "left_semi", facts_stored=stored)


def shuffled(df: DataFrame, keys: Sequence[str], salt: str = "shuffle", seed: int = SEED) -> DataFrame:
    """``df`` in a random order, with its place from 1 as ``place``."""
    drawn = df.withColumn("_bits", draw_bits(keys, salt, seed))
    return rank_within(drawn, "place", [F.col("_bits").asc(), *[F.col(k).asc() for k in keys]]).drop("_bits")
