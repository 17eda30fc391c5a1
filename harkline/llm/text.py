"""Words of many texts at once, as arrays, and how arrays travel between tasks.

A word is ``[^\\x20\\x09-\\x0D]+``: what lies between ASCII white space. Texts are handled as
UTF-8 bytes. Words, shingles and lines are told apart by 64-bit hashes where the caller
says so; two given texts of a thousand shingles each then disagree with a comparison of
the words themselves with a chance below 1e-12.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The pattern of a word, for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Text is worked on in chunks of about so many bytes.
CHUNK_BYTES = 2_000_000
#: Rows come from Spark in batches of at most so many bytes, or one row.
BATCH_BYTES = 8_000_000

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_LONG_WORD = 256


def word_count(text: str | Column) -> Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lowered(text: str | Column) -> Column:
    """A text column with A-Z as a-z, and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, from which numbers of buckets follow."""
    return docs.agg(F.sum(F.octet_length(text))).head()[0] or 0


def any_of(number: int, count: int) -> int:
    """One of ``count``, evenly over numbers that may follow each other."""
    return int(mix(np.array([number], np.uint64))[0] % np.uint64(count))


def is_space(buffer: np.ndarray) -> np.ndarray:
    return _SPACE[buffer]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """The words of ``n`` texts: text ``i`` holds words ``first[i]`` to ``first[i + 1]``."""

    data: bytes
    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    at: np.ndarray  # where each text starts in ``buffer``, and where one more would

    @property
    def doc(self) -> np.ndarray:
        """The text each word is of."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]

    def stripped(self) -> Words:
        """The same words without ASCII punctuation at either end, if anything else is in them."""
        plain = np.flatnonzero(~_PUNCTUATION[self.buffer])
        start = plain[np.searchsorted(plain, self.start)]
        end = plain[np.searchsorted(plain, self.end) - 1] + 1
        held = start < self.end
        return replace(self, start=np.where(held, start, self.start), end=np.where(held, end, self.end))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        length = self.end - self.start
        h = length.astype(np.uint64) * _ODD2
        eight = np.ndarray((len(self.buffer) - 7,), "<u8", self.buffer.data, strides=(1,))
        todo, done = np.flatnonzero(length <= _LONG_WORD), 0
        while len(todo):
            left = length[todo] - done
            piece = eight[self.start[todo] + done] & _MASK[np.minimum(left, 8)]
            h[todo] = mix((h[todo] ^ piece) * _ODD2)
            todo, done = todo[left > 8], done + 8
        for i in np.flatnonzero(length > _LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(self.word(i))
        return h

    def spans(self, n: int) -> np.ndarray:
        """Whether ``n`` words of one text start at a word; one entry for each word but the last ``n - 1``."""
        doc = self.doc
        return doc[: len(doc) - n + 1] == doc[n - 1 :] if len(doc) >= n else np.zeros(0, bool)


def words_of(texts: list[bytes | None], lower: bool = False) -> Words:
    """Splits texts into words; ``lower`` turns A-Z into a-z first."""
    data = b"".join([b"\n", b"\n".join([t or b"" for t in texts]), b"\n" + bytes(8)])
    if lower:
        data = _LOWER[np.frombuffer(data, np.uint8)].tobytes()
    buffer = np.frombuffer(data, np.uint8)
    space = _SPACE[buffer[:-8]]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    at = np.cumsum([1, *[len(t or b"") + 1 for t in texts]])
    return Words(data, buffer, start, end, np.searchsorted(start, at), at)


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` neighbours of ``h``, by doubling."""
    if len(h) < n:
        return h[:0]
    runs, size, out, have = h, 1, None, 0
    while True:
        if n & size:
            out = runs if out is None else mix(out[: len(h) - have - size + 1] * _ODD2 + runs[have : have + len(h) - have - size + 1])
            have += size
        if size * 2 > n:
            return out[: len(h) - n + 1]
        runs = mix(runs[: len(runs) - size] * _ODD2 + runs[size:])
        size *= 2


def bound_batches(spark: SparkSession) -> None:
    """Lets tasks get their input in batches of at most ``BATCH_BYTES``, from now on in this session.

    A batch is held by the JVM outside its heap and by the Python worker, whole. Results do not depend on it.
    """
    named = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(named).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(named, str(BATCH_BYTES))


def hand_back() -> None:
    """Gives freed memory back to the system; a Python worker lives on for the next tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each has about ``size`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        part = total // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        hand_back()


def raw(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype: type | str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising whole numbers, as their differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob: bytes, dtype: type | str) -> np.ndarray:
    return np.cumsum(unpack(blob, dtype), dtype=dtype)
