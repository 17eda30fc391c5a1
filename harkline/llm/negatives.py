"""Hard negatives from Hilbert-ordered blocks with zone maps.

Candidates are laid along a Hilbert curve through their components and stored in Parquet blocks of ``BLOCK`` neighbours,
each with the least and greatest value of every dimension. Anchors are packed alike. For an anchor, interval arithmetic bounds
the inner products with all rows of a block from its zone map. A block is read for the anchors that

* could find one of their first positives there: its upper bound reaches what lower bounds promise of other blocks, and later
  what blocks read before have given;
* could find a negative in a window there: its bounds meet the window below some positive's score.

Anchors are a stated query set; they meet zone maps in pages, and blocks by the pairs chosen. Every score is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze

#: Rows of a candidate block, anchors of an anchor block, zone maps of a page.
BLOCK, ANCHORS, PAGE = 2048, 256, 256
#: Components are kept within plus and minus this, so that products of up to 2 ** 17 dimensions fit 64 bits.
LIMIT = 1 << 22
#: The bits of a Hilbert key are shared out among the dimensions, one to eight each.
KEY_BITS = 256


def whole_components(embedding: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as a double, within ``LIMIT``; null if the vector or any component is null or not finite."""
    embedding = F.col(embedding) if isinstance(embedding, str) else embedding
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale))).cast("int")
    return F.when(embedding.isNotNull() & ~F.coalesce(F.exists(embedding, odd), F.lit(False)), F.transform(embedding, whole))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points with whole coordinates below ``2 ** bits``, as rows of bytes.

    Skilling's transform: from the highest bit down, each axis inverts or exchanges the lower bits of the first, then a Gray code.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, p = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(n):
            inverted = (x[i] & q) > 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(inverted, p, swap).astype(np.uint32)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    last = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        last ^= np.where(x[-1] >> np.uint32(bit) & 1, (1 << bit) - 1, 0).astype(np.uint32)
    x ^= last
    planes = [(x >> np.uint32(bit) & 1).T for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _keyed(width: int, least: int, most: int):
    bits = int(np.clip(KEY_BITS // width, 1, 8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            cells = (x - least) * ((1 << bits) - 1) // max(most - least, 1)
            keys = hilbert_keys(cells, bits)
            yield batch.append_column("key", pa.array([k.tobytes() for k in keys], pa.binary()))

    return run


_BLOCK = "block long, n int, ids binary, labels binary, anchors binary, vectors binary, low binary, high binary, kinds array<long>, counts array<int>"


def _packed(size: int, width: int, anchors_only: bool):
    """Packs rows, in their order, into blocks; repeats of a row, which are neighbours, count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held = TaskContext.get().partitionId() << 32, None, []
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
            flags, x = batch.column("anchor").to_numpy(zero_copy_only=False).astype(bool), _matrix(batch.column("vector"), width)
            rows = np.concatenate([ids[:, None], labels[:, None], x], axis=1)
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            if before is not None and len(rows):
                new[0] = (rows[0] != before).any()
            before = rows[-1] if len(rows) else before
            take = new & flags if anchors_only else new
            held.append((rows[take], flags[take]))
            while sum(len(r) for r, _ in held) >= size:
                rows, flags = (np.concatenate(part) for part in zip(*held))
                yield _block(number, rows[:size], flags[:size])
                number, held = number + 1, [(rows[size:], flags[size:])]
        rows, flags = (np.concatenate(part) for part in zip(*held)) if held else (np.zeros((0, 2)), None)
        if len(rows):
            yield _block(number, rows, flags)

    return run


def _block(number: int, rows: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    ids, labels, x = rows[:, 0], rows[:, 1], rows[:, 2:]
    kinds, counts = np.unique(labels, return_counts=True)
    low, high = x.min(axis=0), x.max(axis=0)
    blobs = [T.pack(np.ascontiguousarray(v)) for v in (ids, labels, flags.astype(np.uint8), x.astype(np.int32).ravel())]
    columns = [
        pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()), *[pa.array([b], pa.binary()) for b in blobs],
        pa.array([low.tobytes()], pa.binary()), pa.array([high.tobytes()], pa.binary()),
        pa.array([kinds.tolist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCK.split(", ")])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; in doubles where they can't lose a bit."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with any point of each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return _products(up, low) + _products(down, high), _products(up, high) + _products(down, low)


def _unpacked(row: dict, prefix: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (T.unpack(row[prefix + c], np.int64) for c in ("ids", "labels"))
    return ids, labels, T.unpack(row[prefix + "vectors"], np.int32).reshape(len(ids), width).astype(np.int64)


def _single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


_PAGE = "page long, blocks binary, page_low binary, page_high binary, page_kinds array<array<long>>, page_counts array<array<int>>"


def _paged(size: int):
    """Zone maps of up to ``size`` blocks as one row."""

    def page(rows: list[dict]) -> pa.RecordBatch:
        columns = [
            pa.array([rows[0]["block"]], pa.int64()), pa.array([np.array([r["block"] for r in rows], np.int64).tobytes()], pa.binary()),
            *[pa.array([b"".join(r[c] for r in rows)], pa.binary()) for c in ("low", "high")],
            pa.array([[r["kinds"] for r in rows]], pa.list_(pa.list_(pa.int64()))), pa.array([[r["counts"] for r in rows]], pa.list_(pa.list_(pa.int32()))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PAGE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in _single_rows(batches):
            held.append(row)
            if len(held) == size:
                yield page(held)
                held = []
        if held:
            yield page(held)

    return run


_PAIRS = "group long, block long, wanted binary, bound long"


def _pairs(found: list[tuple[int, int, np.ndarray, int]]) -> pa.RecordBatch:
    group, block, wanted, bound = zip(*found) if found else ((), (), (), ())
    columns = [pa.array(group, pa.int64()), pa.array(block, pa.int64()), pa.array([w.astype(np.int32).tobytes() for w in wanted], pa.binary()), pa.array(bound, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["group", "block", "wanted", "bound"])


def _choose_positives(width: int, k: int):
    """Blocks in which an anchor may find one of its first ``k`` positives, by zone maps alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _single_rows(batches):
            _, labels, a = _unpacked(row, "a_", width)
            blocks = np.frombuffer(row["blocks"], np.int64)
            low, high = (np.frombuffer(row[c], np.int64).reshape(len(blocks), width) for c in ("page_low", "page_high"))
            below, above = bounds(a, low, high)
            holds = np.zeros((len(a), len(blocks)), np.int64)
            for z, (kinds, counts) in enumerate(zip(row["page_kinds"], row["page_counts"])):
                places = np.searchsorted(kinds, labels)
                places[places == len(kinds)] = 0
                holds[:, z] = np.where(np.array(kinds)[places] == labels, np.array(counts)[places], 0)
            # Blocks by falling lower bound: where k rows besides the anchor are reached, their bound is a floor.
            order = np.argsort(-below, axis=1, kind="stable")
            reached = np.cumsum(np.take_along_axis(holds, order, 1), axis=1) > k
            at = np.argmax(reached, axis=1)
            floor = np.where(reached.any(axis=1), np.take_along_axis(np.take_along_axis(below, order, 1), at[:, None], 1)[:, 0], np.iinfo(np.int64).min)
            need = (holds > 0) & (above >= floor[:, None])
            yield _pairs([(row["group"], int(b), np.flatnonzero(need[:, z]), int(above[need[:, z], z].max())) for z, b in enumerate(blocks) if need[:, z].any()])

    return run


def _choose_windows(width: int, least: int, most: int):
    """Blocks that may hold a row in the window of an anchor's positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _single_rows(batches):
            _, labels, a = _unpacked(row, "a_", width)
            blocks = np.frombuffer(row["blocks"], np.int64)
            low, high = (np.frombuffer(row[c], np.int64).reshape(len(blocks), width) for c in ("page_low", "page_high"))
            below, above = bounds(a, low, high)
            need = np.zeros(above.shape, bool)
            for p in row["positives"]:
                i, score = p["at"], p["score"]
                need[i] |= (100 * above[i] >= least * score) & (100 * below[i] <= most * score)
            for z, kinds in enumerate(row["page_kinds"]):
                if len(kinds) == 1:
                    need[labels == kinds[0], z] = False
            yield _pairs([(row["group"], int(b), np.flatnonzero(need[:, z]), int(above[need[:, z], z].max())) for z, b in enumerate(blocks) if need[:, z].any()])

    return run


_FOUND = "group long, at int, nth int, score long, id long"


class _Best:
    """The first rows of each anchor or window by falling score and rising id, for the groups seen lately."""

    def __init__(self, k: int, groups: int = 64):
        self.k, self.groups, self.held = k, groups, {}

    def of(self, group: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
        return self.held.setdefault(group, {})

    def add(self, best: dict, key: tuple[int, int], scores: np.ndarray, ids: np.ndarray) -> None:
        best[key] = sorted([*best.get(key, ()), *zip((-scores).tolist(), ids.tolist())])[: self.k]

    def out(self, end: bool = False) -> Iterator[pa.RecordBatch]:
        if self.held and (end or len(self.held) > self.groups):
            rows = [(g, at, nth, -s, i) for g, best in self.held.items() for (at, nth), found in best.items() for s, i in found]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            columns = zip(*rows) if rows else [()] * 5
            self.held = {}
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in _FOUND.split(", ")])


def _read_positives(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for row in _single_rows(batches):
            a_ids, a_labels, a = _unpacked(row, "a_", width)
            low, high = (np.frombuffer(row[c], np.int64).reshape(1, width) for c in ("low", "high"))
            wanted, here = np.frombuffer(row["wanted"], np.int32), best.of(row["group"])
            # What was read before may already be out of this block's reach.
            floors = np.array([-here[i, 0][-1][0] if len(here.get((i, 0), ())) == k else np.iinfo(np.int64).min for i in wanted.tolist()])
            wanted = wanted[bounds(a[wanted], low, high)[1][:, 0] >= floors]
            if not len(wanted):
                continue
            ids, labels, x = _unpacked(row, "", width)
            scores = _products(a[wanted], x)
            for i, s in zip(wanted.tolist(), scores):
                fits = np.flatnonzero(labels == a_labels[i])
                itself = fits[ids[fits] == a_ids[i]]
                fits = np.setdiff1d(fits, itself[(x[itself] == a[i]).all(axis=1)])
                if len(fits) > k:
                    fits = fits[s[fits] >= np.partition(s[fits], len(fits) - k)[len(fits) - k]]
                first = fits[np.lexsort((ids[fits], -s[fits]))][:k]
                if len(first):
                    best.add(here, (i, 0), s[first], ids[first])
            yield from best.out()
        yield from best.out(end=True)

    return run


def _read_windows(width: int, k: int, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for row in _single_rows(batches):
            _, a_labels, a = _unpacked(row, "a_", width)
            ids, labels, x = _unpacked(row, "", width)
            wanted, here = np.frombuffer(row["wanted"], np.int32), best.of(row["group"])
            windows: dict[int, list[tuple[int, int]]] = {}
            for p in row["positives"]:
                windows.setdefault(p["at"], []).append((p["nth"], p["score"]))
            scores = _products(a[wanted], x)
            for i, s in zip(wanted.tolist(), scores):
                fits = np.flatnonzero((labels != a_labels[i]) & (100 * s >= least * min(w for _, w in windows[i])))
                fits = fits[np.lexsort((ids[fits], -s[fits]))]
                falling = -100 * s[fits]
                for nth, score in windows[i]:
                    a_, b_ = np.searchsorted(falling, -most * score), np.searchsorted(falling, -least * score, "right")
                    first = fits[a_ : min(b_, a_ + k)]
                    if len(first):
                        best.add(here, (i, nth), s[first], ids[first])
            yield from best.out()
        yield from best.out(end=True)

    return run


def _firsts(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and window, with their ``rank``; each task has sent ``k`` of each at most."""
    order = Window.partitionBy("group", "at", "nth").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_hard_negatives(
    rows: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 5, least: int = 80, most: int = 100
) -> DataFrame:
    """For each anchor and positive, negatives whose scores are ``least`` to ``most`` percent of the positive's.

    ``rows`` has ``vec_id``, ``label`` (whole numbers) and ``vector``, an array of whole numbers (see ``whole_components``).
    ``anchor`` says which rows are anchors. Scores are inner products. An anchor's positives are its first other rows of its label,
    by falling score and rising id; negatives are the first rows of other labels in the window, in the same order.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; an anchor or positive with nothing to
    show has no row. Rows with a null id, label or vector take no part; shorter vectors are filled with zeros; a row that is
    repeated with the same id, label and vector counts once. Other columns are ignored. No rows give no rows.
    """
    spark = rows.sparkSession
    # Named afresh, so that other columns can't clash.
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<int>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).dropna()
    told = rows.agg(F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).head()
    width = max(told[0] or 0, 1)
    schema = f"{rows.schema.simpleString()[7:-1]},key:binary"
    keyed = rows.mapInArrow(_keyed(width, told[1] or 0, told[2] or 0), schema)
    # Equal vectors are spread by id, so that a common one fills many blocks.
    order = ["key", "vec_id", "label", "vector"]
    blocks = freeze(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(BLOCK, width, False), _BLOCK))
    chosen = freeze(keyed.filter("anchor").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(ANCHORS, width, True), _BLOCK))
    anchors = chosen.select(F.col("block").alias("group"), *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "vectors")])
    pages = freeze(blocks.select("block", "low", "high", "kinds", "counts").mapInArrow(_paged(PAGE), _PAGE))

    def paired(groups: DataFrame) -> DataFrame:
        # Each anchor block meets each page of zone maps: query set by blocks, a few rows a page.
        numbers = [r["page"] for r in pages.select("page").collect()]
        spread = groups.withColumn("page", F.explode(F.array(*map(F.lit, numbers)).cast("array<long>")))
        return spread.join(pages, "page")

    def read(pairs: DataFrame, groups: DataFrame, reader) -> DataFrame:
        pairs = freeze(pairs)
        stored = blocks.select("block", "ids", "labels", "vectors", "low", "high")
        return freeze(pairs.join(groups, "group").join(stored, "block").mapInArrow(reader, _FOUND))

    pairs = paired(anchors).mapInArrow(_choose_positives(width, n_positives), _PAIRS)
    positives = freeze(_firsts(read(pairs, anchors, _read_positives(width, n_positives)), n_positives).withColumn("nth", F.col("rank") - 1))
    windows = positives.groupBy("group").agg(F.collect_list(F.struct("at", "nth", "score")).alias("positives"))
    windowed = freeze(anchors.join(windows, "group"))
    pairs = paired(windowed).mapInArrow(_choose_windows(width, least, most), _PAIRS)
    negatives = _firsts(read(pairs, windowed, _read_windows(width, n_negatives, least, most)), n_negatives)

    names = chosen.select(F.col("block").alias("group"), "n", "ids").mapInArrow(_named, "group long, at int, anchor_id long")
    positives = positives.select("group", "at", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    negatives = negatives.select("group", "at", "nth", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return negatives.join(positives, ["group", "at", "nth"]).join(names, ["group", "at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _single_rows(batches):
        ids = T.unpack(row["ids"], np.int64)
        columns = [pa.array(np.full(len(ids), row["group"], np.int64)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)]
        yield pa.RecordBatch.from_arrays(columns, names=["group", "at", "anchor_id"])
