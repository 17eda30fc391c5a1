"""Ranked lexical search by a document FP-tree.

Terms are runs of letters and digits: everything but the other ASCII characters, with A-Z as a-z. Each document is
restricted to the terms of the items and written down once as a vector of term frequencies. Frequencies over
all documents then order the terms, the most common first, and a task lays the documents of a chunk out in a trie in that order, where
documents with the same common terms share a path. Each node knows the largest tf of every term and the smallest m below it. An item
walks the trie depth first, best bound first, and leaves out what can't reach its tenth score so far, over all chunks of
the task. Small neighbouring branches are one leaf, whose documents are scored exactly.

Terms are told apart by 64-bit hashes. All arithmetic after the weights is in whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze

#: Items are searched for in blocks of about so many bytes of text.
ITEM_BYTES = 4_000_000
#: Documents and postings of a trie, documents of a leaf.
TREE_ROWS, TREE_POSTINGS, LEAF = 8192, 4_000_000, 64

# Everything that is no part of a term becomes a space, A-Z becomes a-z.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(texts: list[bytes | None]) -> T.Words:
    """The terms of texts; none for null."""
    return T.words_of([None if t is None else t.translate(_PLAIN) for t in texts])


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_share(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m."""
    return 10 + (90 * n * n_docs) // max(n_terms, 1)


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


_VECTOR = "n long, terms array<int>, tfs array<int>"


def _restricted(vocabulary: np.ndarray):
    """Each document's number of terms, and those in the vocabulary with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            words = terms_of(T.raw(batch.column("text")))
            at = np.searchsorted(vocabulary, hashes := words.hashes())
            at[at == len(vocabulary)] = 0
            held = np.flatnonzero(vocabulary[at] == hashes)
            pairs, tfs = np.unique(words.doc[held].astype(np.int64) * len(vocabulary) + at[held], return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * len(vocabulary)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32))) for v in (pairs % len(vocabulary), tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(words.first).astype(np.int64)), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and the size of each list."""
    return column.flatten().to_numpy().astype(np.int64), np.diff(column.offsets.to_numpy()).astype(np.int64)


def _document_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(_flat(batch.column("terms"))[0], minlength=size)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["term", "df"])

    return run


class Tree:
    """A trie of documents, each a list of terms by falling document frequency (0 is the most common)."""

    def __init__(self, ids: list, m: np.ndarray, terms: np.ndarray, tfs: np.ndarray, sizes: np.ndarray, n_terms: int, leaf: int = LEAF):
        starts = np.concatenate([[0], np.cumsum(sizes)])
        # Ranks as big-endian numbers sort like the paths.
        wide = terms.astype(">u4").tobytes()
        order = sorted(range(len(ids)), key=lambda i: wide[4 * starts[i] : 4 * starts[i + 1]])
        take = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in order]) if order else np.zeros(0, np.int64)
        self.ids, self.m = [ids[i] for i in order], m[order]
        self.terms, self.tfs, self.sizes = terms[take], tfs[take], sizes[order]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.doc = np.repeat(np.arange(len(order)), self.sizes)
        self.spans: list[tuple[int, int]] = []
        self.children: list[np.ndarray | None] = []
        most: list[np.ndarray] = []
        least: list[int] = []

        def add(first: int, last: int, depth: int) -> int:
            """A node over documents ``first`` to ``last`` that share ``depth`` terms; children come before their parent."""
            kids = None
            while last - first > leaf:
                cuts = self._branches(first, last, depth)
                if len(cuts) > 2:
                    kids = np.array([add(a, b, depth + 1) for a, b in _joined(cuts, leaf)])
                    break
                if self.sizes[first] <= depth:
                    break  # all are alike
                depth += 1
            if kids is None:
                tops = np.zeros(n_terms, np.int64)
                held = slice(self.starts[first], self.starts[last])
                np.maximum.at(tops, self.terms[held], self.tfs[held])
                most.append(tops)
                least.append(int(self.m[first:last].min()))
            else:
                most.append(np.max([most[c] for c in kids], axis=0))
                least.append(min(least[c] for c in kids))
            self.spans.append((first, last))
            self.children.append(kids)
            return len(self.spans) - 1

        self.root = add(0, len(order), 0)
        self.most, self.least = np.array(most), np.array(least)

    def _branches(self, first: int, last: int, depth: int) -> np.ndarray:
        """Where the term at ``depth`` changes, from ``first`` to ``last``."""
        at = self.starts[first:last] + depth
        step = np.full(last - first, -1, np.int64)
        longer = self.sizes[first:last] > depth
        step[longer] = self.terms[at[longer]]
        return np.concatenate([[first], np.flatnonzero(np.diff(step)) + first + 1, [last]])

    def search(self, item: np.ndarray, weights: np.ndarray, place: np.ndarray, best: list, k: int) -> list:
        """``best``, the first ``k`` of (-score, id is null, id), with this trie's documents.

        ``place`` has the item's terms by their number, -1 elsewhere.
        """
        stack = [(0, self.root)]
        while stack:
            negative, node = stack.pop()
            if len(best) == k and -negative < -best[-1][0] and node != self.root:
                continue
            kids = self.children[node]
            if kids is None:
                first, last = self.spans[node]
                held = slice(self.starts[first], self.starts[last])
                at = place[self.terms[held]]
                mine = np.flatnonzero(at >= 0)
                docs = self.doc[held][mine]
                gains = weights[at[mine]] * _gain(self.tfs[held][mine], self.m[docs])
                scores = np.zeros(last - first, np.int64)
                np.add.at(scores, docs - first, gains)
                floor = -best[-1][0] if len(best) == k else 1
                for i in np.flatnonzero(scores >= max(floor, 1)).tolist():
                    best.append((-int(scores[i]), self.ids[first + i] is None, self.ids[first + i] or 0))
                best = sorted(best)[:k]
                continue
            bounds = (weights * _gain(self.most[kids][:, item], self.least[kids][:, None])).sum(axis=1)
            floor = -best[-1][0] if len(best) == k else 1
            fits = np.flatnonzero(bounds >= floor)
            stack.extend((-int(bounds[i]), int(kids[i])) for i in fits[np.argsort(bounds[fits], kind="stable")])
        return best


def _joined(cuts: np.ndarray, leaf: int) -> list[tuple[int, int]]:
    """Spans between cuts, small neighbours as one."""
    out: list[tuple[int, int]] = []
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        if out and b - out[-1][0] <= leaf:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


_FOUND = "item int, doc_id long, score long"


def _searched(items: list[np.ndarray], weights: np.ndarray, rank: np.ndarray, n_docs: int, n_terms: int, k: int, rows: int, leaf: int):
    """The first ``k`` documents of a task for each item. ``weights`` are by rank, ``rank`` by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items]
        place = np.full(len(rank), -1, np.int64)
        for ids, n, terms, tfs, sizes in _trees(batches, rank, rows):
            tree = Tree(ids, length_share(n, n_docs, n_terms), terms, tfs, sizes, len(rank), leaf)
            for i, item in enumerate(items):
                place[item] = np.arange(len(item))
                best[i] = tree.search(item, weights[item], place, best[i], k)
                place[item] = -1
        firsts = [(i, None if null else doc, -score) for i, found in enumerate(best) for score, null, doc in found]
        columns = zip(*firsts) if firsts else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    return run


def _trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray, size: int) -> Iterator[tuple]:
    """Documents with terms of the items, in chunks for one trie each; terms as ranks, rising."""
    held, rows, postings = [], 0, 0

    def chunk():
        ids = [i for part in held for i in part[0]]
        return ids, *(np.concatenate([part[k] for part in held]) for k in range(1, 5))

    for batch in batches:
        step = max(size // 8, 1)
        for part in (batch.slice(c, step) for c in range(0, batch.num_rows, step)):
            (terms, sizes), (tfs, _) = _flat(part.column("terms")), _flat(part.column("tfs"))
            ranks = rank[terms]
            order = np.lexsort((ranks, np.repeat(np.arange(len(sizes)), sizes)))
            some = np.flatnonzero(sizes)
            ids = part.column("doc_id").to_pylist()
            held.append(([ids[i] for i in some.tolist()], part.column("n").to_numpy()[some], ranks[order], tfs[order], sizes[some]))
            rows, postings = rows + len(some), postings + len(terms)
            if rows >= size or postings >= TREE_POSTINGS:
                yield chunk()
                held, rows, postings = [], 0, 0
    if rows:
        yield chunk()


def item_blocks(items: DataFrame, size: int = ITEM_BYTES) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Items with the hashes of their terms, in blocks of about ``size`` bytes of text; rows of one id are one item."""
    texts = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.collect_list("text").alias("texts")).orderBy("item_id")
    block, held = [], 0
    for row in texts.toLocalIterator():
        raw = [t.encode() for t in row["texts"]]
        block.append((row["item_id"], np.unique(terms_of(raw).hashes())))
        held += sum(map(len, raw))
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_id, rank, doc_id, score``.

    ``docs`` has ``doc_id`` (a whole number) and ``text``, ``items`` has ``item_id`` and ``text``. Only scores above 0 count; equal scores are in order of
    id, null ids last. Null texts have no terms; documents without terms count nowhere. Every row of ``docs`` is a document, repeats and rows with
    one id as well; rows of ``items`` with one id (or a null one) are one item. An item without documents has no row. Other columns
    are ignored. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    T.bound_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for block in item_blocks(items, item_bytes):
        vocabulary = np.unique(np.concatenate([h for _, h in block]))
        if not len(vocabulary):
            continue
        vectors = freeze(texts.mapInArrow(_restricted(vocabulary), f"doc_id long, {_VECTOR}"))
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).head()
        # One count for each term of the items.
        counted = vectors.select("terms").mapInArrow(_document_counts(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = np.zeros(len(vocabulary), np.int64)
        for row in counted.collect():
            df[row["term"]] = row["df"]
        order = np.argsort(-df, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        weights = np.array([weight(int(d), n_docs) for d in df[order]], np.int64)
        searched = [np.sort(rank[np.searchsorted(vocabulary, h)]) for _, h in block]
        found = vectors.mapInArrow(_searched(searched, weights, rank, n_docs, n_terms, k, TREE_ROWS, LEAF), _FOUND)
        first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id long")
        parts.append(freeze(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")))
    out = parts[0] if parts else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
