"""The largest inner products of many vectors with many others, without all pairs.

The second side is taken in falling order of its norms, in bounded chunks that are sent to every task. A vector
keeps its best so far, and is done once its norm times the next norm can't reach the last of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from harkline.operators.frozen import freeze
from harkline.operators.running import rank_within

#: Bytes of a chunk of the second side; it passes through the driver and to each task.
CHUNK_BYTES = 64_000_000
#: Vectors and items that are multiplied at a time.
ROWS, ITEMS = 1024, 1024
#: Vectors whose norms are taken at a time.
_WIDENED = 65_536
#: Products are compared as 32-bit numbers, bounds with room for their rounding.
_ROOM = 1 + 1e-6


class Items:
    """Vectors with ids, by falling norm.

    They are put in order once, on the driver, and kept as they came: only ``ITEMS`` at a time are widened, for each product.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        norms = np.concatenate([np.zeros(0), *(np.linalg.norm(vectors[a : a + _WIDENED].astype(float), axis=1) for a in range(0, len(ids), _WIDENED))])
        order = np.lexsort((ids, -norms))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]


def best_products(
    rows: np.ndarray, want: np.ndarray, items: Items, best: list[tuple[np.ndarray, np.ndarray]]
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """``best``, the ids and products of each row's ``want`` best, with ``items``; and how many pairs were multiplied.

    Products are in falling order, equal ones by id.
    """
    best, pairs = list(best), 0
    norms = np.linalg.norm(rows, axis=1)
    floors = np.array([s[w - 1] if len(s) >= w > 0 else -np.inf for (_, s), w in zip(best, want.tolist())], float)
    floors[want <= 0] = np.inf
    for at in range(0, len(items.ids), ITEMS):
        open_rows = np.flatnonzero(norms * items.norms[at] * _ROOM >= floors)
        if not len(open_rows):
            break
        ids = items.ids[at : at + ITEMS]
        products = (rows[open_rows] @ items.vectors[at : at + ITEMS].astype(float).T).astype(np.float32)
        pairs += products.size
        for j in np.flatnonzero(products.max(axis=1) >= floors[open_rows]).tolist():
            i, p = int(open_rows[j]), products[j]
            w = int(want[i])
            fits = np.flatnonzero(p >= floors[i])
            if len(fits) > w:
                fits = fits[p[fits] >= np.partition(p[fits], len(fits) - w)[len(fits) - w]]
            all_ids, all_p = np.concatenate([best[i][0], ids[fits]]), np.concatenate([best[i][1], p[fits]])
            first = np.lexsort((all_ids, -all_p))[:w]
            best[i] = all_ids[first], all_p[first]
            if len(first) == w:
                floors[i] = all_p[first[-1]]
    return best, pairs


_STATE = "id int, features array<float>, want int, ids array<int>, products array<float>"


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else [], kind))


def _with_chunk(chunk):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.__new__(Items)
        items.ids, items.vectors, items.norms = chunk.value
        for batch in batches:
            for part in (batch.slice(a, ROWS) for a in range(0, batch.num_rows, ROWS)):
                rows = part.column("features").flatten().to_numpy().astype(float).reshape(part.num_rows, -1)
                before = [(np.array(i, np.int32), np.array(p, np.float32)) for i, p in zip(part.column("ids").to_pylist(), part.column("products").to_pylist())]
                best, _ = best_products(rows, part.column("want").to_numpy(), items, before)
                columns = [part.column(c) for c in ("id", "features", "want")]
                columns += [_lists([b[0] for b in best], pa.int32()), _lists([b[1] for b in best], pa.float32())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "features", "want", "ids", "products"])

    return run


def top_products(vectors: DataFrame, items: DataFrame, want: Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(id, at, item, product)``: for each of ``vectors``, the ``want`` items with the largest products, ``at`` from 0.

    Both have ``id`` (int) and ``features`` (float arrays of one length); ``want`` is a column of ``vectors``. A row's work depends on its
    own ``want`` only. Equal products are in order of id.
    """
    spark = vectors.sparkSession
    size = F.size("features")
    n, width = items.agg(F.count(F.lit(1)), F.max(size)).head()
    step = max(1, chunk_bytes // (4 * (width or 1) + 4))
    if n > step:
        norm = F.aggregate("features", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
        items = freeze(rank_within(items.select("id", "features", norm.alias("norm")), "place", [F.col("norm").desc(), F.col("id").asc()]))
    none = F.array()
    state = vectors.select(
        F.col("id").cast("int").alias("id"), "features", want.cast("int").alias("want"), none.cast("array<int>").alias("ids"), none.cast("array<float>").alias("products")
    )
    for first in range(0, n, step):
        part = items if n <= step else items.filter(F.col("place").between(first + 1, first + step))
        got = part.select("id", "features").toArrow()
        chunk = Items(got.column("id").to_numpy().astype(np.int32), got.column("features").combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1))
        state = state.mapInArrow(_with_chunk(spark.sparkContext.broadcast((chunk.ids, chunk.vectors, chunk.norms))), _STATE)
        if first + step < n:
            state = freeze(state)
    listed = state.select("id", F.posexplode(F.arrays_zip("ids", "products")).alias("at", "found"))
    return listed.select("id", "at", F.col("found.ids").alias("item"), F.col("found.products").alias("product"))
