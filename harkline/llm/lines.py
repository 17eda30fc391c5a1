"""Line dedup by winnowing: later copies of runs of lines go.

Lines without a word are left out. Of a text's other lines, every two neighbours have a hash, and of every
``WINDOW`` such hashes in a row the smallest is a fingerprint, so two texts that share a run of
``SURE_LINES`` lines share a fingerprint in it. Fingerprints that occur more than once are extended both ways: to the next
fingerprint, and by each number of lines up to where another one must begin. Each extended run is looked up by
its hash, so it meets the earliest place of just that run, and a run that has an earlier place goes.
Shorter runs count by their words: every line and every two neighbours with ``LONG_WORDS`` words or more are
fingerprints and runs of their own.

Lines are equal if their words are. Runs are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze

#: Lines in a fingerprint, and fingerprints of which one is kept.
LINES, WINDOW = 2, 2
#: Runs of SURE_LINES lines or more are found whatever their words, shorter ones if they have LONG_WORDS words.
SURE_LINES = LINES + WINDOW - 1
LONG_WORDS = 20
#: The fewest lines of a run that goes.
MIN_LINES = 1
#: A null id comes after all others.
_LAST = (1 << 63) - 1


def line_hashes(text: bytes | None) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Numbers, hashes and numbers of words of a text's lines with a word."""
    at, hashes, sizes = [], [], []
    for i, line in enumerate((text or b"").split(b"\n")):
        if words := line.split():
            at.append(i)
            hashes.append(xxhash.xxh64_intdigest(b" ".join(words)))
            sizes.append(len(words))
    return at, np.array(hashes, np.uint64), np.array(sizes, np.int64)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: of each window of pairs the smallest, the last of equal ones.

    With fewer pairs than a window holds there is one fingerprint, if there is a pair.
    """
    pairs = T.run_hashes(hashes, LINES)
    if not len(pairs):
        return np.zeros(0, np.int64)
    wide = min(WINDOW, len(pairs))
    windows = np.lib.stride_tricks.sliding_window_view(pairs, wide)
    return np.unique(np.arange(len(windows)) + wide - 1 - np.argmin(windows[:, ::-1], axis=1))


_PRINTS = "doc long, text_key long, at int, print long, runs array<struct<start:int,stop:int,hash:long>>"


def _runs(hashes: np.ndarray, places: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """For each fingerprint, the runs it is extended to, each at least ``SURE_LINES`` long."""
    n = len(hashes)
    by_size = {k: T.run_hashes(hashes, k).view(np.int64) for k in range(SURE_LINES, LINES + WINDOW + 1)}
    for j, p in enumerate(places.tolist()):
        spans = {(p - more, p + LINES) for more in range(1, WINDOW)} | {(p, p + LINES + more) for more in range(1, WINDOW)}
        if j + 1 < len(places):
            spans.add((p, int(places[j + 1]) + LINES))
        yield [(a, b, int(by_size[b - a][a])) for a, b in sorted(spans) if a >= 0 and b <= n and b - a >= SURE_LINES]


def _long_runs(hashes: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of fewer than ``SURE_LINES`` lines that have ``LONG_WORDS`` words."""
    words = np.concatenate([[0], np.cumsum(sizes)])
    for k in range(MIN_LINES, min(SURE_LINES, len(hashes) + 1)):
        marks = T.run_hashes(hashes, k).view(np.int64)
        for a in np.flatnonzero(words[k:] - words[:-k] >= LONG_WORDS).tolist():
            yield a, a + k, int(marks[a])


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("hash", pa.int64())]))
    for chunk in T.chunks(batches):
        rows = []
        for doc, key, text in zip(chunk.column("doc").to_pylist(), chunk.column("text_key").to_pylist(), T.raw(chunk.column("text"))):
            _, hashes, sizes = line_hashes(text)
            places = fingerprints(hashes)
            marks = T.run_hashes(hashes, LINES).view(np.int64)
            for p, runs in zip(places.tolist(), _runs(hashes, places)):
                if runs:
                    rows.append((doc, key, p, int(marks[p]), [{"start": a, "stop": b, "hash": h} for a, b, h in runs]))
            for a, b, h in _long_runs(hashes, sizes):
                rows.append((doc, key, a, h, [{"start": a, "stop": b, "hash": h}]))
        if rows:
            columns = list(zip(*rows))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), kind]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc", "text_key", "at", "print", "runs"])


def without_runs(text: bytes | None, spans: list[dict] | None) -> tuple[int, int, bytes | None]:
    """Lines with a word, how many of them go, and the text without them and the blank lines between them."""
    at, _, _ = line_hashes(text)
    hit = np.zeros(len(at) + 1, bool)
    for s in spans or []:
        hit[s["start"] : s["stop"]] = True
    if not hit.any():
        return len(at), 0, text
    lines = text.split(b"\n")
    out = np.zeros(len(lines), bool)
    for i, a in enumerate(at):
        if hit[i]:
            out[a : at[i + 1] if hit[i + 1] else a + 1] = True
    return len(at), int(hit.sum()), b"\n".join(line for line, o in zip(lines, out) if not o)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in T.chunks(batches):
        counts, gone, kept = zip(*map(without_runs, T.raw(chunk.column("text")), chunk.column("spans").to_pylist()))
        kept = pa.array(kept, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [chunk.column("row"), kept, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], names=["row", "text", "line_count", "lines_removed"]
        )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``(doc, text_key, start, stop)``: runs of lines that have an earlier place; lines with a word are numbered from 0."""
    T.bound_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("text_key"), "text")
    prints = freeze(rows.mapInArrow(_print, _PRINTS))
    twice = prints.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print")
    runs = prints.join(twice, "print", "left_semi").select("doc", "text_key", F.explode("runs").alias("run"))
    runs = freeze(runs.select("doc", "text_key", "run.start", "run.stop", F.col("run.hash").alias("hash")))
    # The earliest place of each run is counted up before it is moved; a run in very many texts is a
    # large partition of the join only, which is split.
    first = runs.groupBy("hash").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return runs.join(first, "hash").filter(F.struct("doc", "start") > F.col("first")).select("doc", "text_key", "start", "stop")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of a row of ``docs``), ``text`` without lines of runs that occur earlier, ``line_count``, ``lines_removed``.

    Earlier is a smaller ``doc_id``, or the same and an earlier line. All lines of any run of ``SURE_LINES`` lines or more,
    or of ``LONG_WORDS`` words or more, that occurs earlier go, and no others; runs are judged on the input. A text that keeps all its lines keeps its bytes.

    Null and empty texts stay as they are, a null id is the last. Rows with one id and one text are one
    document and lose the same lines. No rows give no rows. ``docs`` must read alike each time (a stored table).
    """
    spans = repeated_runs(docs).distinct().groupBy("doc", "text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("text_key"))
    rows = rows.join(spans, ["doc", "text_key"], "left").select("row", "text", "spans")
    added = rows.select("row", "text").limit(0).withColumns({c: F.lit(0).cast("long") for c in ("line_count", "lines_removed")})
    return rows.mapInArrow(_cut, added.schema)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that stay; a document of which no word is left goes, if it had lines that went."""
    left = dedup_lines(docs).filter((F.col("lines_removed") == 0) | (F.col("lines_removed") < F.col("line_count")))
    return left.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
