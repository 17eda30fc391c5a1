"""N-gram Jaccard join: documents whose shingle sets overlap by at least a given share, as components.

The incidence matrix of documents by shingles is never written out. It is made in blocks of documents, cut
into ranges of shingles, and each range meets in one task:

1. Each block sends, by range, its shingles and how many of its documents have each. What comes back is how
   many documents have it in all, for those that more than one has.
2. Shingles are ordered from rare to common. A set of n shingles that reaches similarity t with another
   shares one of its first n - ceil(t n) + 1. A shingle that only one document has links nothing, so a document whose first
   part is made of those is done; most are.
3. Sets that are equal become one. For the others, the first parts are the sparse rows that meet by shingle. First each set is
   compared with one partner: of each shingle's sets the one that has most in common with all others, and of several such
   the one that shares the most. That joins most large groups at once. Then only pairs of different groups are left: those that sizes and places in the order allow are
   counted in full.

Shingles are 64-bit hashes where they are counted and 48 bits of them where sets are compared: the chance that two
sets of a thousand each seem to share one more than they do is about 4e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from harkline.llm import text as T
from harkline.llm.components import roots, smallest_reachable
from harkline.operators.frozen import freeze

SHINGLE = 5
#: Similarity in percent from which two documents are linked.
PERCENT = 75
#: Bytes of text whose shingles make a range, on average.
RANGE_BYTES = 8_000_000
#: A shingle that more documents of one block have is counted in its range, but its documents stay behind.
MANY = 64
_LAST = (1 << 63) - 1
_BITS = 48

_SENT = "range int, block long, kind int, grams binary, held binary, docs binary"
_BACK = "block long, kind int, grams binary, held binary, docs binary, total binary"
_SETS = "doc long, text_key long, n long, node long, alone long, common double, grams binary, first array<long>"


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text numbers and hashes, sorted, and how many each text has.

    A text with fewer words than a shingle has them all as one; a text without words has none.
    """
    words = T.words_of(texts, lower=True)
    hashes, n = words.hashes(), np.diff(words.first)
    at = np.flatnonzero(words.spans(size))
    doc, grams = words.doc[at], T.run_hashes(hashes, size)[at]
    short = np.flatnonzero((n > 0) & (n < size))
    whole = [int(T.run_hashes(hashes[words.first[i] : words.first[i + 1]], int(n[i]))[0]) ^ int(n[i]) for i in short]
    doc, grams = np.concatenate([doc, short]), np.concatenate([grams, np.array(whole, np.uint64)])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return doc[new], grams[new], np.bincount(doc[new], minlength=len(texts))


def first_part(n: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    """How many of the rarest of n shingles any set that is similar enough must share one of."""
    return n - (n * percent + 99) // 100 + 1


def _send(ranges: int, most: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, chunk in enumerate(T.chunks(batches)):
            block = (part << 32) | number
            any_range = T.any_of(block, ranges)  # what is not a range's own comes back to the block by any of them
            doc, grams, n = shingle_sets(T.raw(chunk.column("text")))
            first = np.concatenate([[0], np.cumsum(n)])
            nodes = np.array([xxhash.xxh3_64_intdigest(grams[a:b].tobytes()) for a, b in zip(first, first[1:])], np.uint64).view(np.int64)
            short = grams >> np.uint64(64 - _BITS)
            order = np.argsort(short, kind="stable")
            short, doc = short[order], doc[order].astype(np.uint32)
            begin = np.flatnonzero(np.diff(short, prepend=np.uint64(1 << 63)) != 0) if len(short) else np.zeros(0, np.int64)
            distinct, held = short[begin], np.diff(np.append(begin, len(short)))
            many = np.repeat(held > most, held)
            rows = [(any_range, block, 2, T.pack(chunk.column("doc").to_numpy()), T.pack(n.astype(np.uint32)), T.pack(nodes))]
            rows.append((any_range, block, 3, T.pack(chunk.column("text_key").to_numpy()), b"", b""))
            if many.any():
                rows.append((any_range, block, 1, T.pack_sorted(distinct[held > most]), T.pack(held[held > most].astype(np.uint32)), T.pack(doc[many])))
            few = np.concatenate([[0], np.cumsum(np.where(held > most, 0, held))])
            doc = doc[~many]
            cuts = np.searchsorted(distinct, [(r << _BITS) // ranges for r in range(ranges)] + [1 << _BITS])
            for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    rows.append((r, block, 0, T.pack_sorted(distinct[a:b]), T.pack(held[a:b].astype(np.uint32)), T.pack(doc[few[a] : few[b]])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3))],
                names=["range", "block", "kind", "grams", "held", "docs"],
            )

    return send


def _count(most: int):
    def count(table: pa.Table) -> pa.Table:
        """Counts a range's shingles over all blocks; sends each block those that others, or more of its documents, have too."""
        rows, out = table.filter(pc.equal(table.column("kind"), 0)).to_pylist(), []
        counted = [(r, T.unpack_sorted(r["grams"], np.uint64), T.unpack(r["held"], np.uint32)) for r in rows]
        if counted:
            every, back = np.unique(np.concatenate([g for _, g, _ in counted]), return_inverse=True)
            total = np.bincount(back, np.concatenate([h for _, _, h in counted])).astype(np.int64)
            at = 0
            for r, grams, held in counted:
                of = total[back[at : at + len(grams)]]
                at += len(grams)
                twice = of > 1
                if twice.any():
                    sent = np.where(held > most, 0, held)
                    docs = T.unpack(r["docs"], np.uint32)[np.repeat(twice, sent)]
                    out.append((r["block"], 0, T.pack_sorted(grams[twice]), T.pack(held[twice]), T.pack(docs), T.pack(of[twice])))
        columns = zip(*out) if out else [[]] * 6
        types = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
        made = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "kind", "grams", "held", "docs", "total"])
        passed = table.filter(pc.greater(table.column("kind"), 0)).select(made.column_names[:-1])
        passed = passed.append_column("total", pa.nulls(len(passed), pa.binary()))
        return pa.concat_tables([made, passed.cast(made.schema)])

    return count


def _gather(most: int):
    def gather(table: pa.Table) -> pa.Table:
        """The sets of a block's documents: all shingles that others have too, and the first part, for those that may be linked."""
        grams, docs, total, many, meta = [], [], [], None, None
        counts_of_many: dict[int, int] = {}
        for r in table.to_pylist():
            if r["kind"] == 2:
                meta = (T.unpack(r["grams"], np.int64), T.unpack(r["held"], np.uint32).astype(np.int64), T.unpack(r["docs"], np.int64))
            elif r["kind"] == 3:
                keys = T.unpack(r["grams"], np.int64)
            elif r["kind"] == 1:
                many = (T.unpack_sorted(r["grams"], np.uint64), T.unpack(r["held"], np.uint32), T.unpack(r["docs"], np.uint32))
            else:
                g, h, t = T.unpack_sorted(r["grams"], np.uint64), T.unpack(r["held"], np.uint32), T.unpack(r["total"], np.int64)
                hot = h > most
                counts_of_many.update(zip(g[hot].tolist(), t[hot].tolist()))
                grams.append(np.repeat(g[~hot], h[~hot]))
                total.append(np.repeat(t[~hot], h[~hot]))
                docs.append(T.unpack(r["docs"], np.uint32))
        if many:
            grams.append(np.repeat(many[0], many[1]))
            total.append(np.repeat(np.array([counts_of_many[g] for g in many[0].tolist()], np.int64), many[1]))
            docs.append(many[2])
        ids, n, nodes = meta
        g, t, d = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (grams, total, docs))
        order = np.lexsort((g, t, d))
        g, d = g[order], d[order].astype(np.int64)
        shared = np.bincount(d, minlength=len(ids))
        common = np.bincount(d, t[order], minlength=len(ids)) / np.maximum(n, 1)
        begin = np.concatenate([[0], np.cumsum(shared)])
        alone = n - shared
        more = first_part(n) - alone
        sets, firsts = [], []
        for i in range(len(ids)):
            if n[i] and more[i] > 0:
                own = g[begin[i] : begin[i + 1]]
                firsts.append(own[: more[i]].view(np.int64))
                sets.append(T.pack_sorted(np.sort(own)))
            else:
                firsts.append(None)
                sets.append(None)
        return pa.table(
            {"doc": ids, "text_key": keys, "n": n, "node": nodes, "alone": alone, "common": common, "grams": pa.array(sets, pa.binary()), "first": pa.array(firsts, pa.list_(pa.int64()))}
        )

    return gather


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_grams", "b_grams"))):
                both = np.concatenate([T.unpack_sorted(x, np.uint64), T.unpack_sorted(y, np.uint64)])
                both.sort()
                overlap = int((both[1:] == both[:-1]).sum())
                linked.append(100 * overlap >= percent * (a + b - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verify


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose whole sets are similar enough."""
    for side in ("a", "b"):
        own = sets.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("grams").alias(f"{side}_grams"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(_verify(percent), "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, most: int = MANY) -> DataFrame:
    """``doc_id``, ``text_key`` (a hash of the text), ``n_shingles``, ``component_id`` and ``class_id`` of every row of ``docs``
    (``doc_id``, ``text``).

    ``component_id`` is the smallest id of all documents that a document is linked to, directly or over others;
    ``class_id`` the smallest of those with the same set. A text without words has no shingle and stands alone. Rows with
    one id are linked as their texts are. A null id comes after all others; alone, its component is null. ``docs`` must
    read alike each time (a stored table). No rows give no rows.
    """
    T.bound_batches(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(2 * partitions, T.text_bytes(docs) // RANGE_BYTES)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("text_key"), "text")
    sent = rows.mapInArrow(_send(ranges, most), _SENT)
    back = sent.groupBy("range").applyInArrow(_count(most), _BACK)
    held = freeze(back.groupBy("block").applyInArrow(_gather(most), _SETS))

    alike = held.filter("grams is not null").groupBy("node").agg(
        F.min("doc").alias("doc"), F.any_value("n").alias("n"), F.any_value("alone").alias("alone"), F.any_value("common").alias("common"), F.any_value("grams").alias("grams"), F.any_value("first").alias("first")
    )
    sets = freeze(alike)
    firsts = sets.select("node", "n", "alone", "common", F.posexplode("first").alias("place", "gram"))
    firsts = freeze(firsts.select("node", "n", "common", "gram", (F.col("n") - F.col("alone") - F.col("place")).alias("left")))

    # One partner for each set, of those whose shingles are the commonest: what others are copies of.
    hubs = firsts.groupBy("gram").agg(F.max(F.struct("common", "node", "n")).alias("hub"), F.count("*").alias("sets")).filter("sets > 1")
    fits = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    met = firsts.join(hubs, "gram").filter(F.col("node") != F.col("hub.node")).filter(fits(F.col("n"), F.col("hub.n")))
    best = met.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count("*").alias("shared")).groupBy("node").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    # A hub comes before the others of its shingle in one order of all, so these links are trees.
    links = _links(best.select(F.col("node").alias("a"), F.col("hub").alias("b")), sets, percent)
    group = roots(links.select(F.col("a").alias("node"), F.col("b").alias("parent")))

    # All pairs of different groups that sizes and places allow.
    grouped = firsts.join(group, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = grouped.groupBy("gram").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("gram")
    grouped = freeze(grouped.join(mixed, "gram", "left_semi"))
    x, y = grouped.alias("x"), grouped.alias("y")
    # Two sets of x and y shingles are similar enough if they share t / (1 + t) of x + y.
    enough = (100 + percent) * F.least(F.col("x.left"), F.col("y.left")) >= percent * (F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, F.col("x.gram") == F.col("y.gram")).filter("x.node < y.node and x.root <> y.root")
    pairs = pairs.filter(fits(F.col("x.n"), F.col("y.n")) & enough).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    links = _links(pairs, sets, percent)
    for side in ("a", "b"):
        own = group.select(F.col("node").alias(side), "root")
        links = links.join(own, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    joined = smallest_reachable(links).select(F.col("node").alias("first_root"), F.col("root").alias("joined_root"))

    members = sets.select("node", F.col("doc").alias("class_id")).join(group, "node", "left").withColumn("first_root", F.coalesce("root", "node"))
    members = freeze(members.join(joined, "first_root", "left").select("node", "class_id", F.coalesce("joined_root", "first_root").alias("root")))
    smallest = members.groupBy("root").agg(F.min("class_id").alias("component_id"))
    members = members.join(smallest, "root").select(F.col("node").alias("of_node"), "class_id", "component_id")
    linked = F.col("grams").isNotNull() & (F.col("node") == F.col("of_node"))
    known = lambda c: F.when(c != _LAST, c)
    return held.join(members, linked, "left").select(
        known(F.col("doc")).alias("doc_id"), "text_key", F.col("n").alias("n_shingles"),
        known(F.coalesce("component_id", "doc")).alias("component_id"), known(F.coalesce("class_id", "doc")).alias("class_id"),
    )


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, as they are.

    Rows with one id and one text are one document. Documents without an id stay if they are linked to none with one.
    """
    others = jaccard_components(docs, percent).filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    others = others.select(F.col("doc_id").alias("_llm_id"), F.col("text_key").alias("_llm_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (F.xxhash64("text") == F.col("_llm_key"))
    return docs.join(others, same, "left_anti")
