"""Running totals and ranks that no hot group can pile up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from harkline.operators.frozen import freeze

# A part holds at most two to this power rows.
PART_BITS = 22


def running_total(
    df: DataFrame, totals: dict[str, Column], order: Sequence[Column], within: Sequence[str] = ()
) -> DataFrame:
    """Adds inclusive running sums, in ``order``, inside each ``within`` group.

    ``totals`` maps a new column name to the whole-number expression to add up.

    Groups of more than a part's rows are added up in parts, the others by a window each. Groups are
    counted for that before their rows are moved; fewer than one row per part is broadcast.
    """
    group = list(within)
    if not group:
        return _in_parts(df, totals, order, group)
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    large = freeze(sizes.filter(F.col("_n") > 2**PART_BITS).select(*[F.col(g).alias(f"_large_{g}") for g in group]))
    if large.isEmpty():
        return _in_windows(df, totals, order, group)
    same = [F.col(g).eqNullSafe(F.col(f"_large_{g}")) for g in group]
    small_rows, large_rows = (df.join(F.broadcast(large), same, how) for how in ("left_anti", "left_semi"))
    return _in_windows(small_rows, totals, order, group).unionByName(_in_parts(large_rows, totals, order, group))


def _in_windows(df: DataFrame, totals: dict[str, Column], order: Sequence[Column], group: list[str]) -> DataFrame:
    here = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[F.sum(e.cast("long")).over(here).alias(n) for n, e in totals.items()])


def _in_parts(df: DataFrame, totals: dict[str, Column], order: Sequence[Column], group: list[str]) -> DataFrame:
    """A window over a group would sort it whole in one task. Here the
    rows are range partitioned by group *and* order, so a large group spreads over
    many partitions, and cut into parts of at most ``2 ** PART_BITS`` rows. Each part
    adds up its own rows, and what earlier parts hold of the same group is added on
    top. Only the group that a part begins with can have started earlier, so there
    is at most one such amount per part, which is what bounds the broadcast.
    """
    ordering = [*[F.col(g).asc() for g in group], *order]
    laid = df.select("*", *[e.cast("long").alias(f"_add_{n}") for n, e in totals.items()])
    laid = laid.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    # Written down, since a second run may number or fill partitions differently. The
    # id counts rows in their order: partitions in its upper bits, rows in its lower.
    row = F.monotonically_increasing_id()
    starts = row.bitwiseAND(2**PART_BITS - 1) == 0
    laid = freeze(laid.select("*", F.shiftright(row, PART_BITS).alias("_part"), starts.alias("_starts")))

    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        _spanning(laid, group)
        .groupBy("_part", *group)
        .agg(*[F.sum(f"_add_{n}").alias(n) for n in totals])
        .select(
            F.col("_part").alias("_carry_part"),
            F.struct(*group, F.lit(0).alias("_any")).alias("_carry_group"),
            F.count("_part").over(earlier).alias("_parts"),
            *[F.sum(n).over(earlier).alias(f"_carry_{n}") for n in totals],
        )
        .filter("_parts > 0")
        .drop("_parts")
    )

    here = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same_group = F.struct(*group, F.lit(0).alias("_any")).eqNullSafe(F.col("_carry_group"))
    return (
        laid.select("*", *[F.sum(f"_add_{n}").over(here).alias(f"_here_{n}") for n in totals])
        .join(F.broadcast(carried), F.col("_part") == F.col("_carry_part"), "left")
        .select(
            *df.columns,
            *[
                (F.col(f"_here_{n}") + F.when(same_group, F.col(f"_carry_{n}")).otherwise(0)).alias(n)
                for n in totals
            ],
        )
    )


def _spanning(laid: DataFrame, group: list[str]) -> DataFrame:
    """Rows of the groups that some part begins with, the only ones that can lie in several parts."""
    if not group:
        return laid
    groups = laid.filter("_starts").select(*[F.col(g).alias(f"_first_{g}") for g in group]).distinct()
    same = [F.col(g).eqNullSafe(F.col(f"_first_{g}")) for g in group]
    return laid.join(F.broadcast(groups), same, "left_semi")


def rank_within(df: DataFrame, name: str, order: Sequence[Column], within: Sequence[str] = ()) -> DataFrame:
    """Adds the 1-based row number in ``order`` inside each group."""
    return running_total(df, {name: F.lit(1)}, order, within)
