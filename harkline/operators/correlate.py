"""Pearson correlation of feature columns, by co-moments that can be merged.

Columns are taken in blocks. Each task keeps, for its rows and each pair of blocks, the number of rows, the means and the
sums of products about the means; two such parts merge exactly. So any number of columns is one route: only
blocks of columns are in memory, never a row's columns as one vector, and the pairs of blocks that a task can't hold at once are another pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harkline.operators.frozen import freeze

#: Columns of a block.
BLOCK = 128
#: Bytes of sums that a task holds at a time.
PASS_BYTES = 64_000_000
#: Values that are added up at a time.
CHUNK_VALUES = 2_000_000

_PART = "a int, b int, n long, mean_a binary, mean_b binary, moments binary"


class CoMoments:
    """Rows, means of two blocks of columns, and the sums of products about them."""

    def __init__(self, n: int, mean_a: np.ndarray, mean_b: np.ndarray, moments: np.ndarray):
        self.n, self.mean_a, self.mean_b, self.moments = n, mean_a, mean_b, moments

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> CoMoments:
        # About the first row, so that a constant column has a sum of exactly 0.
        x, y = a - a[0], b - b[0]
        mean_x, mean_y = x.mean(axis=0), y.mean(axis=0)
        return cls(len(a), a[0] + mean_x, b[0] + mean_y, (x - mean_x).T @ (y - mean_y))

    def merge(self, other: CoMoments) -> CoMoments:
        if not self.n or not other.n:
            return other if other.n else self
        n, off_a, off_b = self.n + other.n, other.mean_a - self.mean_a, other.mean_b - self.mean_b
        share = other.n / n
        return CoMoments(
            n, self.mean_a + off_a * share, self.mean_b + off_b * share, self.moments + other.moments + np.outer(off_a, off_b) * (self.n * share)
        )


def _parts(found: dict[tuple[int, int], CoMoments]) -> pa.RecordBatch:
    rows = [(a, b, c.n, c.mean_a.tobytes(), c.mean_b.tobytes(), c.moments.tobytes()) for (a, b), c in found.items()]
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in _PART.split(", ")])


def _summed(blocks: dict[int, list[str]], pairs: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], CoMoments] = {}
        step = max(1, CHUNK_VALUES // sum(map(len, blocks.values())))
        for batch in batches:
            for part in (batch.slice(a, step) for a in range(0, batch.num_rows, step)):
                x = {k: np.column_stack([part.column(c).to_numpy(zero_copy_only=False) for c in names]) for k, names in blocks.items()}
                for a, b in pairs:
                    here = CoMoments.of(x[a], x[b])
                    found[a, b] = found[a, b].merge(here) if (a, b) in found else here
        if found:
            yield _parts(found)

    return run


_CELLS = "i int, j int, n long, moment double"


def _merged(starts: list[int]):
    """One part after the other, neighbours of one pair of blocks merged; a row for each pair of columns."""

    def cells(key: tuple[int, int], whole: CoMoments) -> Iterator[pa.RecordBatch]:
        i, j = (g.ravel() for g in np.meshgrid(starts[key[0]] + np.arange(len(whole.mean_a)), starts[key[1]] + np.arange(len(whole.mean_b)), indexing="ij"))
        kept = i <= j
        n = np.full(int(kept.sum()), whole.n, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(i[kept], pa.int32()), pa.array(j[kept], pa.int32()), pa.array(n), pa.array(whole.moments.ravel()[kept])], names=["i", "j", "n", "moment"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                mean_a, mean_b = np.frombuffer(r["mean_a"]), np.frombuffer(r["mean_b"])
                part = CoMoments(r["n"], mean_a, mean_b, np.frombuffer(r["moments"]).reshape(len(mean_a), len(mean_b)))
                if (r["a"], r["b"]) != key:
                    if whole is not None:
                        yield from cells(key, whole)
                    key, whole = (r["a"], r["b"]), part
                else:
                    whole = whole.merge(part)
        if whole is not None:
            yield from cells(key, whole)

    return run


def co_moments(df: DataFrame, columns: Sequence[str], block: int = BLOCK, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``(i, j, n, moment)``: rows, and the sum of products about the means, for each pair of columns by place, ``i`` up to ``j``.

    Values are doubles without nulls. Each task sends a part per pair of blocks; parts of one pair are merged one after the
    other, so no task holds more than one of them.
    """
    columns = list(columns)
    starts = list(range(0, len(columns), block))
    names = {k: columns[a : a + block] for k, a in enumerate(starts)}
    pairs = list(combinations_with_replacement(names, 2))
    step = max(1, pass_bytes // (8 * block * block))
    out = None
    for first in range(0, len(pairs), step):
        some = pairs[first : first + step]
        held = {k: names[k] for k in sorted({k for pair in some for k in pair})}
        parts = df.select(*[c for k in held for c in held[k]]).mapInArrow(_summed(held, some), _PART)
        out = parts if out is None else out.unionByName(parts)
    return out.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(_merged(starts), _CELLS)


def feature_correlation(df: DataFrame, columns: Sequence[str], block: int = BLOCK, handle_invalid: str = "error") -> DataFrame:
    """``(i, j, corr)`` for each unordered pair of columns, ``i`` before ``j``.

    A row with a missing value (null or NaN) is an error, or left out if ``handle_invalid`` is ``skip``. A constant
    column, and any column of fewer than two rows, correlates as NaN. The
    result has one row per pair of columns, however many rows ``df`` has.
    """
    if handle_invalid not in ("error", "skip"):
        raise ValueError(f"handle_invalid is 'error' or 'skip', not {handle_invalid!r}")
    columns, spark = list(columns), df.sparkSession
    # Numbered, so that any name will do.
    places = [f"c{k}" for k in range(len(columns))]
    df = df.select(*[F.col(c).cast("double").alias(p) for c, p in zip(columns, places)])
    if handle_invalid == "skip":
        df = df.dropna()
    else:
        wrong = F.raise_error(F.lit("a row to correlate has a missing value")).cast("double")
        df = df.select(*[F.when(F.col(p).isNull() | F.isnan(p), wrong).otherwise(F.col(p)).alias(p) for p in places])
    cells = freeze(co_moments(df, places, block))  # a row per pair of columns
    own = {r["i"]: r["moment"] for r in cells.filter("i = j").collect()}  # one per column
    if not own:
        named = spark.createDataFrame(list(enumerate(columns)), "at int, name string")
        pairs = named.alias("x").join(named.alias("y"), F.col("x.at") < F.col("y.at"))
        return pairs.select(F.col("x.name").alias("i"), F.col("y.name").alias("j"), F.lit(float("nan")).alias("corr"))
    told = spark.createDataFrame([(k, name, own[k]) for k, name in enumerate(columns)], "at int, name string, moment double")
    side = lambda k: F.broadcast(told.select(F.col("at").alias(k), F.col("name").alias(f"{k}_name"), F.col("moment").alias(f"{k}_moment")))
    found = cells.filter("i < j").join(side("i"), "i").join(side("j"), "j")
    product = F.sqrt(F.col("i_moment") * F.col("j_moment"))  # a column and its copy have exactly 1
    corr = F.when((F.col("n") < 2) | (product == 0), F.lit(float("nan"))).otherwise(F.col("moment") / product)
    return found.select(F.col("i_name").alias("i"), F.col("j_name").alias("j"), corr.alias("corr"))


def high_correlation_pairs(correlations: DataFrame, above: float = 0.7, absolute: bool = False) -> DataFrame:
    """Pairs with ``above < r < 1``, strictly; with ``absolute`` also the strongly negative ones."""
    r = F.abs("corr") if absolute else F.col("corr")
    return correlations.filter(~F.isnan("corr") & (r > above) & (r < 1)).withColumn("corr", F.round("corr", 3))
