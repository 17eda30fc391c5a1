"""Boosted trees of many settings grown side by side.

A fit of its own for each setting is a job for each level of each of its trees, most of it waiting for the driver. Here the rows of
all training sides are binned once. Where the binned rows of a side fit into a task, one job grows everything: each task holds the rows of one side and sampling rate in blocks
and makes all rounds of one depth. Larger sides stay in their partitions, and a job counts one level of the current trees of every side, sampling rate and depth;
reducers choose the splits, and only these reach the driver.

The trees are those that ``GBTClassifier`` fits with the same settings: the same candidate splits, the same rows
drawn in each round, the same gains. Exponentials, and sums of several blocks, may differ in their last digit, which decides between splits that part
the rows drawn alike (in deep nodes of few rows).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.operators import metrics
from harkline.session import scratch_dir

MAX_BINS = 32
LEARNING_RATE = 0.1
# Rows of a sample that candidate splits are taken from; fewer rows are all taken.
SPLIT_ROWS = 10_000
# Rounds after which the margins are written down, so that a lost task does not go back to the first round.
CHECKPOINT = 10
EPSILON = float(np.finfo(float).eps)
# Rows that are worked on at a time.
BLOCK_ROWS = 2**17
# What a task may hold of one side's rows; larger sides are grown by a job for each level.
TASK_BYTES = 320 << 20

Lane = tuple[int, int, int]  # training side, sampling rate and depth, by their places


@dataclass
class Tree:
    """A regression tree in heap order: the root is node 1, the children of i are 2i and 2i + 1; a leaf has feature -1.

    Rows of a leaf go on to its left child, which says the same, so that all rows are at one level.
    """

    depth: int
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    #: Nodes of the last level that may still be split, and count, sum and sum of squares of their labels.
    open: np.ndarray = field(init=False)
    stats: np.ndarray | None = field(init=False, default=None)
    #: The same of the rows drawn in each leaf, where asked for.
    leaves: np.ndarray | None = field(init=False, default=None)

    def __post_init__(self):
        size = 2 ** (self.depth + 1)
        self.feature, self.bin, self.value = np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size)
        self.open = np.ones(1, np.int64)

    def start(self, n_rows: int) -> np.ndarray:
        """All rows at the root."""
        return np.ones(n_rows, np.uint8 if self.depth < 8 else np.int32)

    def step(self, bins: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
        """Moves the rows from ``level`` to the next; ``bins`` has a row per feature."""
        first = 1 << level
        split = first + np.flatnonzero(self.feature[first : 2 * first] >= 0)
        feature, cut = self.feature[split], self.bin[split].astype(np.uint8)
        if len(split) <= 4:
            right = np.zeros(len(at), bool)
            for node, f, c in zip(split, feature, cut):
                right |= (at == node) & (bins[f] > c)
        else:
            cuts, places, here = np.full(2 * first, 255, np.uint8), np.zeros(2 * first, np.intp), at.astype(np.intp)
            cuts[split], places[split] = cut, feature.astype(np.intp) * bins.shape[1]
            place = places.take(here, mode="clip")
            place += np.arange(len(at))
            right = bins.ravel().take(place, mode="clip") > cuts.take(here, mode="clip")
        return (at << 1) + right

    def reached(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row reaches."""
        at = self.start(bins.shape[1])
        for level in range(self.depth):
            if (self.feature[1 << level : 2 << level] < 0).all():
                break
            at = self.step(bins, at, level)
        return at

    def grow(self, level: int, found: tuple[np.ndarray, ...]) -> None:
        """Splits the open nodes as :func:`_best_splits` says and opens their children."""
        gain, feature, cut, left, right, parent = found
        self.value[self.open] = _mean(parent)
        split = (gain > 0) & (level < self.depth)
        at = self.open[split]
        self.feature[at], self.bin[at] = feature[split], cut[split]
        kids = np.concatenate([2 * at, 2 * at + 1])
        stats = np.concatenate([left[:, split], right[:, split]], axis=1)
        if level < self.depth:
            ids = np.arange(1 << level, 2 << level)
            self.value[2 * ids] = self.value[ids]
        self.value[kids] = _mean(stats)
        # Without sums of squares, a node shows when it is counted whether its labels differ.
        more = ((np.abs(_variance(stats)) >= EPSILON) | np.isnan(stats[2])) & (level + 1 < self.depth)
        self.open, self.stats = kids[more], stats[:, more]


def _mean(stats: np.ndarray) -> np.ndarray:
    return np.divide(stats[1], stats[0], out=np.zeros_like(stats[1]), where=stats[0] > 0)


def _variance(stats: np.ndarray) -> np.ndarray:
    n, total, squares = stats
    some = n > 0
    n = np.where(some, n, 1.0)
    return np.where(some, (squares - total * total / n) / n, 0.0)


def candidate_splits(rows: DataFrame, seed: int, features: str = "features") -> list[np.ndarray]:
    """The thresholds between bins of each feature: some 31, from all rows or a sample of 10,000.

    Values are counted by Spark; what reaches the driver are the counts of the sample.
    """
    spark = rows.sparkSession
    rows = rows.select(features)
    n_rows = rows.count()
    if not n_rows:
        raise ValueError("no rows to fit")
    width = vector_to_array(F.col(features))
    n_features = rows.select(F.size(width)).head()[0]
    fraction = min(1.0, SPLIT_ROWS / n_rows)
    if fraction < 1:
        # The rows that the library draws.
        drawn = rows._jdf.toJavaRDD().sample(False, fraction, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    values = rows.select(F.posexplode(vector_to_array(F.col(features))).alias("feature", "value")).filter("value != 0")
    counted = values.groupBy("feature", "value").count().groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("value", "count"))).alias("counts"))
    counts = {r["feature"]: r["counts"] for r in counted.collect()}
    return [_thresholds([(v, float(n)) for v, n in counts.get(i, [])], fraction * n_rows, min(MAX_BINS, n_rows) - 1) for i in range(n_features)]


def _thresholds(counts: list[tuple[float, float]], expected: float, most: int) -> np.ndarray:
    """About ``most`` thresholds with as many rows between them; ``counts`` are those of values other than 0."""
    if not counts:
        return np.empty(0)
    seen = sum(n for _, n in counts)
    if expected - seen > EPSILON * seen * 100:
        counts = sorted([*counts, (0.0, expected - seen)])
    middles = [(a + b) / 2 for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(middles) <= most:
        return np.array(middles)
    stride = expected / (most + 1)
    found, upto, target = [], counts[0][1], stride
    for middle, (_, n) in zip(middles, counts[1:]):
        before, upto = upto, upto + n
        # A threshold lies where the count is nearest to the target.
        if abs(before - target) < abs(upto - target):
            found.append(middle)
            target += stride
    return np.array(found)


def _binned(x: np.ndarray, splits: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(s, x[:, i]) for i, s in enumerate(splits)]).astype(np.uint8)


def _paired(bins: np.ndarray, n_bins: int) -> np.ndarray:
    """Codes of two features each, the first as the upper digit: half as many sums for a little adding up later."""
    upper = bins[::2] * np.uint16(n_bins)
    upper[: len(bins) // 2] += bins[1::2]
    return upper


def _arrays(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


@dataclass
class _Block:
    """Rows of one side at one sampling rate: bins by feature, labels of -1 and 1, and a bit per round and row drawn, if not all are.

    Those of small sides are ``exact``: added up in their order, as the library does.
    """

    side: int
    rate: int
    place: tuple[int, int]
    bins: np.ndarray
    label: np.ndarray
    drawn: np.ndarray | None
    exact: bool

    def rows(self, m: int) -> np.ndarray | None:
        """Places of the rows drawn in round ``m``; nothing stands for all."""
        return None if self.drawn is None else np.flatnonzero(np.unpackbits(self.drawn[m], count=len(self.label)))


def _some(values: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
    return values if rows is None else values.take(rows, axis=-1, mode="clip")


def _packed(side: int, first: int, splits: list[np.ndarray], rates: Sequence[float], exact: bool) -> Callable:
    """Blocks of one partition's rows for each sampling rate."""
    bounds = sorted({rate for rate in rates if rate < 1})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, done, part = [], 0, 0, 0

        def blocks() -> pa.RecordBatch:
            bins, label, passed = [np.concatenate(a, axis=-1) for a in zip(*held)]
            drawn = [None if rate >= 1 else np.packbits(passed <= bounds.index(rate), axis=1) for rate in rates]
            made = [_Block(side, i, (first + part, done), bins, label, d, exact) for i, d in enumerate(drawn)]
            return pa.RecordBatch.from_arrays([pa.array([(first + part) * len(rates) + i for i in range(len(rates))], pa.int32()), pa.array([pickle.dumps(b) for b in made], pa.binary())], ["place", "block"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            label = batch.column("class").to_numpy(zero_copy_only=False)
            if not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("classes must be 0 or 1")
            # How many of the rates each draw is not below.
            draws = _arrays(batch, "draws")
            passed = sum(((draws >= rate).astype(np.uint8) for rate in bounds), np.zeros(draws.shape, np.uint8))
            held.append((_binned(_arrays(batch, "x"), splits), (2 * label - 1).astype(np.int8), passed.T))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield blocks()
                held, n, done = [], 0, done + 1
        if held:
            yield blocks()

    return pack


def _blocks(sides: Sequence[DataFrame], splits: Sequence[list[np.ndarray]], rates: Sequence[float], rounds: int, seed: int, features: str, label: str, exact: bool, whole: bool) -> RDD:
    """The blocks of all sides, with all those of a side and sampling rate in one partition if ``whole``.

    Otherwise many parts have a partition for each rate. A few are dealt to as many as run at once, as a task costs more than a block.
    """
    context = sides[0].sparkSession.sparkContext
    parts, found = [rows.rdd.getNumPartitions() for rows in sides], []
    for i, rows in enumerate(sides):
        # Each round draws its rows by a seed of its own.
        draws = F.array(*[F.rand(seed + 1 + m) for m in range(rounds if min(rates) < 1 else 0)]).cast("array<double>")
        wide = rows.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("class"), F.spark_partition_id().alias("part"), draws.alias("draws"))
        found.append(wide.mapInArrow(_packed(i, sum(parts[:i]), splits[i], rates, exact), "place int, block binary").rdd)
    blocks = context.union(found)
    if whole:
        side_of = [i for i, n in enumerate(parts) for _ in range(n)]
        lane = lambda place: side_of[place // len(rates)] * len(rates) + place % len(rates)
        blocks, places = blocks.map(lambda r: (lane(r["place"]), bytes(r["block"]))), len(sides) * len(rates)
    else:
        places, cores = sum(parts) * len(rates), context.defaultParallelism
        blocks, places = blocks.map(lambda r: (r["place"], bytes(r["block"]))), places if places > 4 * cores else min(places, cores)
    return blocks.partitionBy(places, int).map(lambda r: pickle.loads(r[1]))


def _slopes(label: np.ndarray, margins: np.ndarray, exact: bool) -> np.ndarray:
    """The slopes of the logistic loss, which the next trees are fitted to; long doubles round the exponential to the nearest double."""
    label = label.astype(float)
    power = 2.0 * label * margins
    power = np.exp(power.astype(np.longdouble)).astype(float) if exact else np.exp(power)
    return 4.0 * label / (1.0 + power)


def _sums(tree: Tree, n_bins: int, bins: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Count, sum and sum of squares of ``wanted`` by feature, open node and bin, each in the order of the rows."""
    n_open = len(tree.open)
    base, squares = _places(tree, tree.open, n_open).take(at, mode="clip") * n_bins, wanted * wanted
    sums = np.empty((3, len(bins), n_open, n_bins))
    for i, bin in enumerate(bins):
        cell = base + bin
        for j, what in enumerate((None, wanted, squares)):
            sums[j, i] = np.bincount(cell, what, (n_open + 1) * n_bins)[: n_open * n_bins].reshape(n_open, -1)
    return sums


def _places(tree: Tree, nodes: np.ndarray, other: int) -> np.ndarray:
    """The place of each node among ``nodes``, or ``other``."""
    places = np.full(len(tree.feature), other, np.intp)
    places[nodes] = np.arange(len(nodes))
    return places


def _squares(tree: Tree, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Sums of squares by open node."""
    n_open = len(tree.open)
    return np.bincount(_places(tree, tree.open, n_open).take(at, mode="clip"), wanted * wanted, n_open + 1)[:n_open]


def _sums_of_pairs(tree: Tree, nodes: np.ndarray, n_features: int, n_bins: int, rows: Iterable[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Count and sum by feature, node of ``nodes`` and bin, over codes of two features each; nothing for squares, which cancel out of gains.

    ``rows`` are codes, nodes, and labels as the imaginary part of ones, so that one pass adds up both.
    """
    size, places = n_bins * n_bins, _places(tree, nodes, len(nodes))
    of_code = np.zeros((-(-n_features // 2), len(nodes) * size), complex)
    for codes, at, wanted in rows:
        base = places.take(at, mode="clip")
        if len(nodes) < len(tree.feature) and base.max(initial=0) == len(nodes):
            some = np.flatnonzero(base < len(nodes))
            base, codes, wanted = base.take(some, mode="clip"), codes.take(some, axis=1, mode="clip"), wanted.take(some, mode="clip")
        base *= size
        for added, code in zip(of_code, codes):
            np.add.at(added, base + code, wanted)
    sums = np.zeros((3, n_features, len(nodes), n_bins))
    for i, added in enumerate(of_code):
        added = added.reshape(len(nodes), n_bins, n_bins)
        for j, feature in enumerate((added.sum(axis=2), added.sum(axis=1))[: n_features - 2 * i]):
            sums[0, 2 * i + j], sums[1, 2 * i + j] = feature.real, feature.imag
    return sums


def _best_splits(n_splits: Sequence[int], parent: np.ndarray | None, sums: np.ndarray, squares: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Per open node: gain, feature and bin of its best split, and the statistics of both children and its own; the first of equals.

    Where ``squares`` has those of nodes, nodes of equal labels are found by them, and ``sums`` need none.
    """
    by_node = squares is not None
    upto, widths, nodes = sums.cumsum(axis=3), np.asarray(n_splits), np.arange(sums.shape[2])
    left = upto[..., :-1]
    right = upto[..., -1:] - left
    if parent is None:
        used = np.flatnonzero(widths)
        parent = left[:, used[0], :, 0] + right[:, used[0], :, 0] if len(used) else upto[:, 0, :, -1]
    if by_node:
        parent = np.stack([parent[0], parent[1], sums[2, 0].sum(axis=1)])
    total = left[0] + right[0]
    total = np.where(total > 0, total, 1.0)
    gain = _variance(parent)[:, None] - left[0] / total * _variance(left) - right[0] / total * _variance(right)
    may = (left[0] >= 1) & (right[0] >= 1) & (gain >= 0) & (np.arange(left.shape[3]) < widths[:, None, None])
    if by_node:
        parent[2] = squares
        # A variance of a few last digits of the squares is none.
        may &= (np.abs(_variance(parent)) >= EPSILON * np.maximum(1.0, 4.0 * _mean(parent) ** 2))[:, None]
    # A bin too many, so that there is one without any split.
    gain = np.pad(np.where(may, gain, -np.inf), ((0, 0), (0, 0), (0, 1)), constant_values=-np.inf).transpose(1, 0, 2).reshape(len(nodes), -1)
    at = gain.argmax(axis=1)
    feature, cut = np.divmod(at, upto.shape[3])
    lefts = upto[:, feature, nodes, cut]
    rights = upto[:, feature, nodes, -1] - lefts
    if by_node:
        lefts[2] = rights[2] = np.nan
    return gain[nodes, at], feature, cut, lefts, rights, parent


def _large_sums(tree: Tree, sums: np.ndarray | None, n_splits: Sequence[int], rows: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """The sums of all open nodes, from those of their parents and a pass over the rows of the smaller child of each."""
    n_features, n_bins = len(n_splits), 1 + max(n_splits)
    if sums is None:
        return _sums_of_pairs(tree, tree.open, n_features, n_bins, rows)
    half = len(tree.open) // 2
    left_first = tree.stats[0, :half] <= tree.stats[0, half:]
    small = _sums_of_pairs(tree, np.where(left_first, tree.open[:half], tree.open[half:]), n_features, n_bins, rows)
    large = sums - small
    # What is left of a bin without rows is no digit of rounding.
    large[1][large[0] == 0] = 0.0
    first = left_first[:, None]
    return np.concatenate([np.where(first, small, large), np.where(first, large, small)], axis=2)


def _fitted(blocks: Sequence[_Block], n_splits: Sequence[int], depth: int, rounds: int, leaves: bool) -> list[Tree]:
    """All rounds on the blocks of one side and sampling rate, which one task holds."""
    margins: list[np.ndarray | None] = [None] * len(blocks)
    grown, exact, n_bins = [], blocks[0].exact, 1 + max(n_splits)
    for m in range(rounds):
        tree, state, sums = Tree(depth), [], None
        for block, margin in zip(blocks, margins):
            rows = block.rows(m)
            label, bins = _some(block.label, rows), _some(block.bins, rows)
            wanted = label.astype(float) if margin is None else _slopes(label, _some(margin, rows), exact)
            both = wanted if exact else 1 + 1j * wanted
            state.append([bins if exact else _paired(bins, n_bins), None if rows is None else rows.astype(np.int32), both, tree.start(len(block.label))])
        for level in range(max(1, depth)):
            if not len(tree.open):
                break
            here = [(codes, _some(at, rows), both) for codes, rows, both, at in state]
            if exact:
                found = _best_splits(n_splits, tree.stats, sum(_sums(tree, n_bins, *of_block) for of_block in here))
            else:
                sums = _large_sums(tree, sums, n_splits, here)
                # The first labels are 1 and -1.
                sums[2] = 0 if m else sums[0]
                found = _best_splits(n_splits, tree.stats, sums, np.full(len(tree.open), np.inf) if m else sums[0, 0].sum(axis=1))
                # Nodes of equal labels gain nothing but digits of rounding.
                if m and ((found[0] > 0) & (found[0] <= 1e-9 * _mean(found[5]) ** 2)).any():
                    found = _best_splits(n_splits, tree.stats, sums, sum(_squares(tree, at, both.imag) for _, at, both in here))
                sums = sums[:, :, found[0] > 0]
            tree.grow(level, found)
            if level < depth:
                for block, of_block in zip(blocks, state):
                    of_block[3] = tree.step(block.bins, of_block[3], level)
        if leaves:
            tree.leaves = sum(_leaves(tree, _some(at, rows), both if exact else both.imag) for _, rows, both, at in state)
        for i, (*_, at) in enumerate(state):
            said = tree.value.take(at, mode="clip")
            margins[i] = said if margins[i] is None else margins[i] + said * LEARNING_RATE
        tree.open, tree.stats = tree.open[:0], None
        grown.append(tree)
    return grown


def _leaves(tree: Tree, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Count, sum and sum of squares of the labels by leaf."""
    stats = np.stack([np.bincount(at, w, len(tree.feature)) for w in (None, wanted, wanted * wanted)])
    for node in range(len(tree.feature) // 2 - 1, 0, -1):
        if tree.feature[node] < 0:
            stats[:, node] += stats[:, 2 * node]
    return stats


def _fits_of(depth: int, depths: Sequence[int], n_splits: Sequence[list[int]], rounds: int, leaves: bool) -> Callable:
    def fit(blocks: Iterator[_Block]) -> Iterator[tuple[Lane, list[Tree]]]:
        if held := sorted(blocks, key=lambda b: b.place):
            yield (held[0].side, held[0].rate, depth), _fitted(held, n_splits[held[0].side], depths[depth], rounds, leaves)

    return fit


def bytes_held(n_rows: int, n_features: int, rounds: int) -> int:
    """About what a task holds of one side: bins, codes of those drawn in a round, their places and labels, all bits, margins and nodes."""
    return n_rows * (n_features + 2 * -(-n_features // 2) + rounds // 8 + 30)


def boost(
    sides: Sequence[DataFrame], splits: Sequence[list[np.ndarray]], rates: Sequence[float], depths: Sequence[int], rounds: int, seed: int,
    features: str = "features", label: str = "class", leaves: bool = False,
) -> dict[Lane, list[Tree]]:
    """The trees of ``rounds`` rounds on each of ``sides`` at each sampling rate and depth.

    Sides that a task can hold are grown in one job, others by a job for each level. Rows of one block have their sums in the order of the
    rows, as the library does; more rows are summed by pairs of features. ``leaves`` asks for the statistics of leaves, which the first route has.
    """
    n_splits, sizes = [[len(s) for s in of_side] for of_side in splits], [rows.count() for rows in sides]
    exact = max(rows.rdd.getNumPartitions() for rows in sides) == 1 and max(sizes) < BLOCK_ROWS
    whole = bytes_held(max(sizes), max(map(len, splits)), rounds) <= TASK_BYTES
    state = _blocks(sides, splits, rates, rounds, seed, features, label, exact, whole).persist(StorageLevel.MEMORY_AND_DISK)
    if not whole:
        return _by_levels(sides[0].sparkSession, state, n_splits, [(i, r, d) for i in range(len(sides)) for r in range(len(rates)) for d in range(len(depths))], depths, rounds)
    # The deepest trees take longest, so they begin.
    order = sorted(range(len(depths)), key=lambda d: -depths[d])
    found = dict(state.context.union([state.mapPartitions(_fits_of(d, depths, n_splits, rounds, leaves)) for d in order]).collect())
    state.unpersist()
    return found


def _ways(tree: Tree, n_features: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the leaves that each bin of each feature leaves to a row, and the leaves' values.

    The lowest bit that all features leave is the leaf a row reaches. A feature that leaves all makes their number even.
    """
    bits, values = np.full((n_features + n_features % 2, n_bins), 2**64 - 1, np.uint64), np.zeros(64)

    def walk(node: int, first: int, size: int) -> None:
        if (feature := tree.feature[node]) < 0:
            values[first : first + size] = tree.value[node]
            return
        size //= 2
        bits[feature, tree.bin[node] + 1 :] &= np.uint64(2**64 - 1 - ((1 << size) - 1 << first))
        walk(2 * node, first, size)
        walk(2 * node + 1, first + size, size)

    walk(1, 0, 2**tree.depth)
    return bits, values


def _said(ways: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """What a tree of at most 64 leaves says of each row; ``codes`` are of two features, as whole numbers."""
    (bits, values), left = ways, None
    for i, code in enumerate(codes):
        of_code = (bits[2 * i][:, None] & bits[2 * i + 1]).ravel().take(code, mode="clip")
        left = of_code if left is None else np.bitwise_and(left, of_code, out=left)
    # A power of two as a double has its exponent in the bits above the 52nd.
    leaf = (left & (~left + np.uint64(1))).astype(float).view(np.int64)
    leaf >>= 52
    leaf -= 1023
    return values.take(leaf, mode="clip")


def _advanced(held: Broadcast[dict[Lane, Tree]], depths: int, weight: float) -> Callable:
    """Adds a round's trees to the margins of a block."""

    def advance(of_block: tuple) -> tuple:
        trees, (block, margins, _) = held.value, of_block
        said = np.stack([(t := trees[block.side, block.rate, d]).value[t.reached(block.bins)] * weight for d in range(depths)])
        margins = said if margins is None else margins + said
        return block, margins, _slopes(block.label, margins, block.exact)

    return advance


def _histograms(m: int, trees: dict[Lane, Tree], depths: int, n_splits: Sequence[list[int]]) -> Callable:
    """The sums of each lane over the rows of a block drawn in round ``m``."""

    def count(of_block: tuple) -> Iterator[tuple[Lane, tuple[np.ndarray, ...]]]:
        block, _, slopes = of_block
        lanes = [d for d in range(depths) if len(trees[block.side, block.rate, d].open)]
        if not lanes:
            return
        rows, widths = block.rows(m), n_splits[block.side]
        bins = _some(block.bins, rows)
        codes = None if block.exact else _paired(bins, 1 + max(widths))
        for d in lanes:
            tree = trees[block.side, block.rate, d]
            wanted = _some(block.label.astype(float) if slopes is None else slopes[d], rows)
            at, lane = tree.reached(bins), (block.side, block.rate, d)
            if block.exact:
                yield lane, (_sums(tree, 1 + max(widths), bins, at, wanted),)
            else:
                sums = _sums_of_pairs(tree, tree.open, len(widths), 1 + max(widths), [(codes, at, 1 + 1j * wanted)])
                sums[2] = 0 if m else sums[0]
                yield lane, (sums, _squares(tree, at, wanted))

    return count


def _by_levels(spark: SparkSession, blocks: RDD, n_splits: Sequence[list[int]], lanes: Sequence[Lane], depths: Sequence[int], rounds: int) -> dict[Lane, list[Tree]]:
    """The trees of sides of any size: a level of one round is one job.

    The rows stay in their partitions with the margins of their lanes; the histograms that are shuffled have a bounded size for each partition, whatever its rows.
    """
    scratch_dir(spark)
    grown: dict[Lane, list[Tree]] = {lane: [] for lane in lanes}
    state = blocks.map(lambda block: (block, None, None))
    reducers = min(len(lanes), spark.sparkContext.defaultParallelism)
    before, written = blocks, None
    for m in range(rounds):
        trees = {lane: Tree(depths[lane[2]]) for lane in lanes}
        for level in range(max(1, *depths)):
            if not any(len(t.open) for t in trees.values()):
                break
            sums = state.flatMap(_histograms(m, trees, len(depths), n_splits)).reduceByKey(lambda a, b: tuple(x + y for x, y in zip(a, b)), reducers)
            parents = {lane: t.stats for lane, t in trees.items()}
            found = dict(sums.map(lambda r: (r[0], _best_splits(n_splits[r[0][0]], parents[r[0]], *r[1]))).collect())
            if m and before is not None:
                before, _ = None, before.unpersist()
                if state.isCheckpointed():
                    _delete(spark, written)
                    written = state.getCheckpointFile()
            for lane, tree in trees.items():
                if len(tree.open):
                    tree.grow(level, found[lane])
        for lane, tree in trees.items():
            grown[lane].append(tree)
        if m + 1 < rounds:
            held = spark.sparkContext.broadcast(trees)
            before, state = before if m == 0 else state, state.map(_advanced(held, len(depths), LEARNING_RATE if m else 1.0)).persist(StorageLevel.MEMORY_AND_DISK)
            if m % CHECKPOINT == CHECKPOINT - 1:
                state.checkpoint()
    state.unpersist()
    blocks.unpersist()
    _delete(spark, written)
    return grown


def area(scores: np.ndarray, positive: np.ndarray) -> float:
    """Area under the ROC curve of rows of both classes, tied scores counting half; exact up to the last division."""
    order = scores.argsort()
    scores, positive = scores[order], positive[order]
    group = np.concatenate([[0], np.cumsum(scores[1:] != scores[:-1])])
    up = np.bincount(group, positive).astype(np.int64)
    down = np.bincount(group) - up
    return float((up * (2 * (down.cumsum() - down) + down)).sum() / (2.0 * up.sum() * down.sum()))


def areas(margins: DataFrame, label: str = "class") -> dict[str, float]:
    """The area under the ROC curve of each column of ``margins`` but ``label``.

    A task adds up a column, where it can hold it; larger ones are counted by score. With rows of one class only, the area is what the library's
    evaluator says: 1 without a negative one, 0 without a positive one, a half without any.
    """
    names = [c for c in margins.columns if c != label]
    up, down = margins.select(F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)).head()
    if not up or not down:
        return dict.fromkeys(names, 1.0 if up else 0.0 if down else 0.5)
    if 48 * (up + down) > TASK_BYTES:
        long = margins.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("score")) for c in names])).alias("m")).select(label, "m.*")
        return {r["column"]: r["auroc"] for r in metrics.auroc(long, label=label, by=["column"]).collect()}

    def columns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                positive = batch.column(label).to_numpy(zero_copy_only=False) == 1
                parts = [[c, batch.column(c).to_numpy(zero_copy_only=False).tobytes(), positive.tobytes()] for c in names]
                yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(zip(*parts), (pa.string(), pa.binary(), pa.binary()))], ["column", "scores", "positive"])

    def of_column(parts: pa.Table) -> pa.Table:
        scores, positive = (np.frombuffer(b"".join(parts[c].to_pylist()), kind) for c, kind in (("scores", float), ("positive", bool)))
        return pa.table({"column": parts["column"][:1], "area": pa.array([area(scores, positive)])})

    parts = margins.mapInArrow(columns, "column string, scores binary, positive binary")
    return {r["column"]: r["area"] for r in parts.groupBy("column").applyInArrow(of_column, "column string, area double").collect()}


def _delete(spark: SparkSession, folder: str | None) -> None:
    """Deletes margins that were written down and are not needed any more."""
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged_margins(rows: DataFrame, splits: list[np.ndarray], fits: Sequence[Sequence[Tree]], stages: Sequence[int], features: str = "features", label: str = "class") -> DataFrame:
    """``label`` and the columns ``m<fit>_<rounds>``: what the first rounds of each fit say about each row."""
    spark = rows.sparkSession
    n_bins = 1 + max(map(len, splits))
    held = spark.sparkContext.broadcast((splits, [[_ways(t, len(splits), n_bins) if t.depth <= 6 else t for t in fit] for fit in fits]))
    names = [f"m{i}_{n}" for i in range(len(fits)) for n in stages]

    def say(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, fits = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, columns = _binned(_arrays(batch, "x"), splits), {}
            codes = _paired(bins, n_bins).astype(np.intp)
            for i, fit in enumerate(fits):
                margin = np.zeros(batch.num_rows)
                for k, tree in enumerate(fit):
                    said = _said(tree, codes) if isinstance(tree, tuple) else tree.value.take(tree.reached(bins))
                    margin = margin + said * (LEARNING_RATE if k else 1.0)
                    for n in stages:
                        if n == k + 1:
                            columns[f"m{i}_{n}"] = margin
            yield pa.RecordBatch.from_arrays([batch.column(label), *[pa.array(columns[c]) for c in names]], [label, *names])

    kind = dict(rows.dtypes)[label]
    return rows.select(vector_to_array(F.col(features)).alias("x"), label).mapInArrow(say, ", ".join([f"{label} {kind}", *[f"{c} double" for c in names]]))
