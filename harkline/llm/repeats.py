"""Substring dedup with super-k-mers: passages that occur earlier lose their words.

A window is ``WINDOW`` words in a row. Each window has a minimiser, the smallest hash of ``MINIMISER`` words in
a row inside it, of long words if there are any. Neighbouring windows mostly share it, and travel as one packed string to the bucket of
their minimiser, where equal windows meet, as they have equal minimisers. There, words are numbered and
windows sorted; equal ones are compared word by word, so the counts are exact. All but the earliest of equal
windows are sent back as runs of words.

Packed strings that occur twice in a chunk of documents are sent once: a passage that very many
documents share reaches its bucket once for each chunk. Buckets grow in number with the text, not in size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from harkline.llm import text as T

WINDOW, MINIMISER = 20, 2
#: Minimisers are taken from longer words first, which are rarer, so that no minimiser has too many windows.
LONG_WORD = 5
#: Bytes of text whose windows share a bucket, on average.
BUCKET_BYTES = 5_000_000
_LAST = (1 << 63) - 1

#: Bytes of text in which packed strings that repeat are sent once.
CHUNK_BYTES = 4_000_000
#: How hard strings and texts are compressed before they are moved.
LEVEL = 6
_PACKED = "bucket int, doc binary, key binary, start binary, stop binary, words binary"
_RUNS = "doc long, key long, start int, stop int"


def _smallest(values: np.ndarray, wide: int) -> np.ndarray:
    """The smallest of each ``wide`` neighbours, by doubling."""
    have = 1
    while have * 2 <= wide:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (wide - have)], values[wide - have :]) if wide > have else values


def _any_of(flags: np.ndarray, wide: int) -> np.ndarray:
    return np.uint64(1) - _smallest(np.uint64(1) - flags, wide)


def _super_windows(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end of words and minimiser of each run of neighbouring windows with one minimiser."""
    if len(words.start) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    short = (words.end - words.start < LONG_WORD).astype(np.uint64)
    order = T.run_hashes(words.hashes(), MINIMISER) >> np.uint64(1) | _any_of(short, MINIMISER) << np.uint64(63)
    least = _smallest(order, WINDOW - MINIMISER + 1)
    at = np.flatnonzero(words.spans(WINDOW))
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]])
    begins = np.flatnonzero(cut)
    ends = np.append(begins[1:], len(at)) - 1
    return (at[begins], at[ends] + WINDOW, least[at[begins]]) if len(at) else (at, at, least[:0])


def _pack(buckets: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batches, CHUNK_BYTES):
            doc, key = chunk.column("doc").to_numpy(), chunk.column("key").to_numpy()
            order = np.argsort(doc, kind="stable")
            doc, key = doc[order], key[order]
            texts = T.raw(chunk.column("text").take(pa.array(order)))
            words = T.words_of(texts)
            begin, end, least = _super_windows(words)
            of = np.searchsorted(words.first, begin, side="right") - 1
            start, stop = begin - words.first[of], end - words.first[of]
            # Words joined by one space each.
            space = T.is_space(words.buffer)
            held = ~space
            held[1:] |= ~space[:-1]
            place = np.cumsum(held)
            data = np.where(space, np.uint8(32), words.buffer)[held].tobytes()
            a, b = place[words.start[begin]] - 1, place[words.end[end - 1] - 1]
            strings = [data[x:y] for x, y in zip(a.tolist(), b.tolist())]
            seen: dict[bytes, tuple[int, int]] = {}
            sent = np.ones(len(strings), bool)
            for i, (s, d, at) in enumerate(zip(strings, doc[of].tolist(), start.tolist())):
                if seen.setdefault(s, (d, at)) < (d, at):
                    sent[i] = False
            bucket = (T.mix(least) % np.uint64(buckets)).astype(np.int64)
            if not sent.all():
                yield _rows([(-1, np.flatnonzero(~sent), b"")], bucket, doc[of], key[of], start, stop, buckets)
            at = np.flatnonzero(sent)
            at = at[np.argsort(bucket[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[at], prepend=-1, append=buckets))
            groups = []
            for x, y in zip(cuts, cuts[1:]):
                part = at[x:y]
                groups.append((int(bucket[part[0]]), part, zstandard.ZstdCompressor(level=LEVEL).compress(b"\n".join([strings[i] for i in part.tolist()]))))
            if groups:
                yield _rows(groups, bucket, doc[of], key[of], start, stop, buckets)

    return pack


def _rows(groups, bucket, doc, key, start, stop, buckets) -> pa.RecordBatch:
    """Rows for buckets. Those without words are runs known to be repeats; they go to any bucket."""
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array([int(bucket[part[0]]) if b < 0 else b for b, part, _ in groups], pa.int32()),
            "doc": [T.pack(doc[part]) for _, part, _ in groups],
            "key": [T.pack(key[part]) for _, part, _ in groups],
            "start": [T.pack(start[part].astype(np.int32)) for _, part, _ in groups],
            "stop": [T.pack(stop[part].astype(np.int32)) for _, part, _ in groups],
            "words": [w for _, _, w in groups],
        }
    )


def _window_hashes(ids: np.ndarray) -> np.ndarray:
    return T.run_hashes(T.mix((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)), WINDOW)


def repeated_windows(ids: np.ndarray, at: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each window of ``ids`` starting at ``at`` equals one that is earlier by ``order`` (document, word)."""
    doc, word = order
    hashes = _window_hashes(ids)[at]
    by = np.lexsort((word, doc, hashes))
    same = hashes[by[1:]] == hashes[by[:-1]]
    pairs = np.flatnonzero(same)
    if len(pairs):
        spread = np.arange(WINDOW)
        if not all((ids[at[by[p]][:, None] + spread] == ids[at[by[p + 1]][:, None] + spread]).all() for p in np.array_split(pairs, len(pairs) // 100_000 + 1)):
            # Two windows share a hash by chance: sort by the words themselves.
            sequence = ids[at[:, None] + spread]
            _, number = np.unique(sequence, axis=0, return_inverse=True)
            hashes = number.ravel()
            by = np.lexsort((word, doc, hashes))
            same = hashes[by[1:]] == hashes[by[:-1]]
    # Of equal windows, the places of the first one are not repeats, also where rows repeat it.
    fresh = np.concatenate([[True], ~same]) if len(by) else np.zeros(0, bool)
    lead = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))] if len(by) else by
    out = np.zeros(len(at), bool)
    out[by] = (doc[by] > doc[lead]) | (word[by] > word[lead])
    return out


def _find(table: pa.Table) -> pa.Table:
    found = _runs_of(table)
    T.hand_back()
    return found


def _runs_of(table: pa.Table) -> pa.Table:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    docs, keys, starts, ids, lengths, known = [], [], [], [], [], []
    for row in table.to_batches():
        for d, k, a, b, w in zip(*(row.column(c).to_pylist() for c in ("doc", "key", "start", "stop", "words"))):
            d, k, a, b = T.unpack(d, np.int64), T.unpack(k, np.int64), T.unpack(a, np.int32), T.unpack(b, np.int32)
            if not w:
                known.append((d, k, a, b))
                continue
            text = zstandard.ZstdDecompressor().decompress(w).split()
            ids.append(np.fromiter(map(numbers.__getitem__, text), np.int32, len(text)))
            docs.append(d), keys.append(k), starts.append(a), lengths.append(b - a)
    numbers.clear()
    if ids:
        doc, key, start, length, words = (np.concatenate(x) for x in (docs, keys, starts, lengths, ids))
        del docs, keys, starts, lengths, ids
        windows = length - WINDOW + 1
        of = np.repeat(np.arange(len(length), dtype=np.int32), windows)
        within = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (np.cumsum(length, dtype=np.int64) - length)[of] + within
        word = start[of] + within
        hit = np.flatnonzero(repeated_windows(words, at, (doc[of], word)))
        first = np.flatnonzero(np.diff(hit, prepend=-2) != 1 if len(hit) else np.zeros(0, bool))
        if len(hit):
            first = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(of[hit], prepend=-1) != 0))
            last = np.append(first[1:], len(hit)) - 1
            own = of[hit[first]]
            known.append((doc[own], key[own], word[hit[first]].astype(np.int32), (word[hit[last]] + WINDOW).astype(np.int32)))
    doc, key, start, stop = (np.concatenate(x) for x in zip(*known)) if known else (np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32))
    return pa.table({"doc": doc.astype(np.int64), "key": key.astype(np.int64), "start": start.astype(np.int32), "stop": stop.astype(np.int32)})


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``(doc, key, start, stop)``: runs of words, counted from 0, that windows with an earlier equal cover."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * partitions, T.text_bytes(docs) // BUCKET_BYTES)
    packed = _keyed(docs).mapInArrow(_pack(buckets), _PACKED)
    return packed.groupBy("bucket").applyInArrow(_find, _RUNS)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("key"), "text")


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in T.chunks(batches):
        packed = [zstandard.ZstdCompressor(level=LEVEL).compress(t or b"") for t in T.raw(chunk.column("text"))]
        yield chunk.select(["doc_id", "doc", "key"]).append_column("packed", pa.array(packed, pa.binary()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            chunk = batch.slice(a, 1000)
            counts, gone, kept = [], [], []
            for packed, runs in zip(chunk.column("packed").to_pylist(), chunk.column("runs").to_pylist()):
                words = zstandard.ZstdDecompressor().decompress(packed).split()
                counts.append(len(words))
                if runs:
                    hit = np.zeros(len(words), bool)
                    for r in runs:
                        hit[r["start"] : r["stop"]] = True
                    words = [w for w, h in zip(words, hit) if not h]
                gone.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [chunk.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])
        T.hand_back()


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by spaces) of every row of ``docs``.

    A word goes if a window that covers it has its words in a row somewhere earlier: in a document with a smaller id, or
    earlier in the same. Windows are judged on the input. ``docs`` must read alike each time (a stored table).

    A null or empty text has no words. A null id comes last. Rows with one id and one text are one document. No rows give no rows.
    """
    T.bound_batches(docs.sparkSession)
    runs = repeated_runs(docs).groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("key"), "text")
    rows = rows.mapInArrow(_zip, "doc_id long, doc long, key long, packed binary")
    return rows.join(runs, ["doc", "key"], "left").select("doc_id", "packed", "runs").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
