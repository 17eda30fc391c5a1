"""Language-model scoring with word classes: a class follows a class, and a class emits a word.

Words that make up at least one in ``FREQUENT`` of the training words (so at most that many) are put into classes by
exchange: each word in turn moves to the class where the bigrams of classes tell most of each other,
until a pass changes little. All other words seen ``MIN_SEEN`` times or more are then exchanged in parts, each range of words in one task: from
the class of its shape, a word moves to the learned class where, against the grid of class bigrams, its neighbours' classes tell most.
Only rarer and unseen words belong to the class of their shape, and the end of a text is a class. With
add-``SMOOTH`` smoothing, P(word | word before) = P(class | class before) * P(word | class), for unseen words too.

Counts of all words never meet in one place. Each chunk of documents sends its distinct words, by range of their
hash, to where they are counted over all chunks, and gets the counts of its own words back; the classes of their neighbours go the
same way, and the words' own classes come back. Words are told apart by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze

FREQUENT = 2_000
#: Words seen so often are in a learned class.
MIN_SEEN = 10
CLASSES = 64
SMOOTH = 0.1
#: Passes of the exchange, at most, and the share of words that must move for another one.
PASSES, MOVING = 10, 0.01
#: Bytes of text whose words make a range, on average.
RANGE_BYTES = 16_000_000
SHAPES = 15
_END = SHAPES  # the end of a text comes after the shapes

_SENT = "range int, block long, kind int, a binary, b binary, c binary, d binary, e binary"
_BACK = "block long, kind int, range int, a binary, b binary, c binary, d binary, e binary"
_SCORED = "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def is_held_out(doc_id: Column) -> Column:
    """Every tenth document by the CRC of its id is not learned from; nor is one without id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def shapes(words: T.Words) -> np.ndarray:
    """The shape of each word: its length in bytes, and whether it has digits or other ASCII characters besides letters."""
    digit = (words.buffer >= 48) & (words.buffer <= 57)
    other = (words.buffer > 32) & (words.buffer < 128) & ~digit & ~((words.buffer >= 97) & (words.buffer <= 122)) & ~((words.buffer >= 65) & (words.buffer <= 90))
    many = lambda flags: (t := np.concatenate([[0], np.cumsum(flags)]))[words.end] - t[words.start]
    kind = np.where(many(digit) > 0, 2, np.where(many(other) > 0, 1, 0))
    return kind * 5 + np.searchsorted([3, 5, 8, 12], words.end - words.start)


def _send(ranges: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, chunk in enumerate(T.chunks(batches)):
            block = (part << 32) | number
            words = T.words_of(T.raw(chunk.column("text")), lower=True)
            n, held_out = np.diff(words.first), chunk.column("held_out").to_numpy(zero_copy_only=False)
            hashes, first, code = np.unique(words.hashes(), return_index=True, return_inverse=True)
            learned = np.bincount(code, np.repeat(~held_out, n), minlength=len(hashes)).astype(np.uint32)
            shape = shapes(words)[first].astype(np.uint8)
            # What is not a range's own comes back to the block by any of them.
            rows = [(T.any_of(block, ranges), block, 1, T.pack(chunk.column("doc").to_numpy()), T.pack(held_out.astype(np.uint8)), T.pack(n.astype(np.uint32)), T.pack(code.astype(np.uint32)), T.pack(shape))]
            high = hashes >> np.uint64(32)
            cuts = np.searchsorted(high, [(r << 32) // ranges for r in range(ranges)] + [1 << 32])
            for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    rows.append((r, block, 0, T.pack_sorted(hashes[a:b]), T.pack(learned[a:b]), T.pack(shape[a:b]), b"", b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5))],
                names=["range", "block", "kind", "a", "b", "c", "d", "e"],
            )

    return send


def _count(learned_words: int):
    """Counts a range's words; tells blocks the counts and which of their words are frequent or seen often, and (kind 2) sums of rare ones by shape."""

    def count(table: pa.Table) -> pa.Table:
        rows, out = table.filter(pc.equal(table.column("kind"), 0)).to_pylist(), []
        own = [(r, T.unpack_sorted(r["a"], np.uint64), T.unpack(r["b"], np.uint32), T.unpack(r["c"], np.uint8)) for r in rows]
        if own:
            hashes = np.concatenate([h for _, h, _, _ in own])
            every, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            total = np.bincount(back, np.concatenate([n for _, _, n, _ in own])).astype(np.uint64)
            shape = np.concatenate([s for _, _, _, s in own])[first]
            frequent = total * np.uint64(FREQUENT) >= max(1, learned_words)
            middle = (total >= MIN_SEEN) & ~frequent
            at = 0
            for r, held, _, _ in own:
                of = back[at : at + len(held)]
                at += len(held)
                hit = np.flatnonzero(frequent[of]).astype(np.uint32)
                mid = np.flatnonzero(middle[of]).astype(np.uint32)
                out.append((r["block"], 0, r["range"], T.pack(total[of]), T.pack(hit), T.pack(held[hit]), T.pack(mid), T.pack_sorted(held[mid])))
            rare = (total > 0) & ~frequent & ~middle
            sums = [np.bincount(shape[rare], w, minlength=SHAPES).astype(np.uint64) for w in (total[rare], np.ones(rare.sum()))]
            out.append((-1, 2, own[0][0]["range"], T.pack(every[frequent]), T.pack(total[frequent]), T.pack(sums[0]), T.pack(sums[1]), b""))
        columns = zip(*out) if out else [[]] * 8
        types = (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5)
        made = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "kind", "range", "a", "b", "c", "d", "e"])
        passed = table.filter(pc.equal(table.column("kind"), 1)).select(made.column_names)
        return pa.concat_tables([made, passed.cast(made.schema)])

    return count


def _pairs(frequent: np.ndarray, shared_order: np.ndarray):
    """Counts neighbours among frequent words, shapes and text ends; at most a fixed number of kinds."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = SHAPES + 1 + len(frequent)
        for chunk in T.chunks(batches):
            words = T.words_of(T.raw(chunk.column("text")), lower=True)
            ids = _ids(words.hashes(), shapes(words), frequent, shared_order)
            line, _ = _with_ends(ids, words.first)
            key, n = np.unique(line[:-1] * size + line[1:], return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": key.astype(np.int64), "n": n.astype(np.int64)})

    return pairs


def _ids(hashes: np.ndarray, shape: np.ndarray, frequent: np.ndarray, order: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return shape.astype(np.int64)
    place = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return np.where(frequent[place] == hashes, SHAPES + 1 + order[place], shape).astype(np.int64)


def _with_ends(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row with an end before the first and after each; and the place of each end."""
    ends = first + np.arange(len(first))
    line = np.full(len(ids) + len(first), _END, np.int64)
    at = np.ones(len(line), bool)
    at[ends] = False
    line[at] = ids
    return line, ends


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, fixed: int = SHAPES + 1, passes: int = PASSES) -> np.ndarray:
    """The class of each id, from the bigram counts of ids. The first ``fixed`` ids are classes of their own.

    The others start dealt over ``classes`` classes by their order, and move one by one to the class that most
    raises the sum of N(g,h) log N(g,h) less those of the margins.
    """
    n = len(pairs)
    own = np.concatenate([np.arange(fixed), fixed + np.arange(n - fixed) % max(1, classes)])
    size = fixed + min(classes, max(0, n - fixed))
    by_next, by_last = np.zeros((n, size)), np.zeros((n, size))  # of each id, with each class
    for g in range(size):
        by_next[:, g] = pairs[:, own == g].sum(1)
        by_last[:, g] = pairs[own == g, :].sum(0)
    grid = np.zeros((size, size))
    np.add.at(grid, own, by_next)
    for _ in range(passes):
        moved = 0
        for w in range(fixed, n):
            a, self_ = own[w], pairs[w, w]
            right, left = by_next[w].copy(), by_last[w].copy()
            right[a] -= self_
            left[a] -= self_
            grid[a, :] -= right
            grid[:, a] -= left
            grid[a, a] -= self_
            gain = _xlogx(grid + right) - _xlogx(grid)  # row b gets right
            gain_left = _xlogx(grid + left[:, None]) - _xlogx(grid)  # column b gets left
            corner = np.diag(grid)
            worth = gain.sum(1) - np.diag(gain) + gain_left.sum(0) - np.diag(gain_left) + _xlogx(corner + right + left + self_) - _xlogx(corner)
            rows, columns = grid.sum(1) + left, grid.sum(0) + right  # w's neighbours count in their margins wherever w is
            worth -= _xlogx(rows + right.sum() + self_) - _xlogx(rows) + _xlogx(columns + left.sum() + self_) - _xlogx(columns)
            worth[:fixed] = -np.inf
            b = int(np.argmax(worth))
            if worth[b] <= worth[a] + 1e-9:
                b = a
            grid[b, :] += right
            grid[:, b] += left
            grid[b, b] += self_
            if b != a:
                own[w], moved = b, moved + 1
                by_next[:, a] -= pairs[:, w]
                by_next[:, b] += pairs[:, w]
                by_last[:, a] -= pairs[w, :]
                by_last[:, b] += pairs[w, :]
        if moved <= MOVING * (n - fixed):
            break
    return own


@dataclass
class ClassModel:
    """All that scoring needs besides the counts of words; its size is bounded by ``FREQUENT`` and ``CLASSES``."""

    frequent: np.ndarray  # hashes, sorted
    order: np.ndarray  # id of each, less SHAPES + 1
    own: np.ndarray  # class of each id
    grid: np.ndarray  # how often a class follows a class
    total: np.ndarray  # training words of each class
    kinds: np.ndarray  # and how many different ones
    texts: int
    words: int

    @property
    def size(self) -> int:
        return len(self.grid)

    @property
    def vocabulary(self) -> int:
        return int(self.kinds.sum())

    @cached_property
    def follows(self) -> np.ndarray:
        """log10 of the chance of a class after a class."""
        return np.log10((self.grid + SMOOTH) / (self.grid.sum(1, keepdims=True) + SMOOTH * self.size))

    @property
    def tokens(self) -> int:
        return self.words + self.texts

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return np.log10((counts + SMOOTH) / (self.total[classes] + SMOOTH * (self.kinds[classes] + 1)))

    def unigram(self, counts: np.ndarray | int) -> np.ndarray:
        different = self.vocabulary + (self.texts > 0)
        return np.log10((counts + SMOOTH) / (self.tokens + SMOOTH * (different + 1)))


class _Block:
    """A chunk of texts as its distinct words, from what ranges sent back."""

    def __init__(self, table: pa.Table, model: ClassModel):
        rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["range"]))
        counts, hits, hashes, at = [], [], [], 0
        self.middle: list[tuple[int, np.ndarray, np.ndarray]] = []  # of each range: words seen often, and their hashes
        for r in (r for r in rows if r["kind"] == 0):
            counts.append(T.unpack(r["a"], np.uint64))
            hits.append(T.unpack(r["b"], np.uint32).astype(np.int64) + at)
            hashes.append(T.unpack(r["c"], np.uint64))
            self.middle.append((r["range"], T.unpack(r["d"], np.uint32).astype(np.int64) + at, T.unpack_sorted(r["e"], np.uint64)))
            at += len(counts[-1])
        meta = next(r for r in rows if r["kind"] == 1)
        self.meta = [meta[c] for c in "abcd"]
        self.held_out, self.n = T.unpack(meta["b"], np.uint8) > 0, T.unpack(meta["c"], np.uint32).astype(np.int64)
        self.code, ids = T.unpack(meta["d"], np.uint32), T.unpack(meta["e"], np.uint8).astype(np.int64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.uint64)
        if at:
            hit, of = np.concatenate(hits), np.concatenate(hashes)
            ids[hit] = SHAPES + 1 + model.order[np.searchsorted(model.frequent, of)]
        self.classes = model.own[ids]
        given = {r["range"]: r["a"] for r in rows if r["kind"] == 4}
        for number, words, _ in self.middle:
            if number in given:
                self.classes[words] = T.unpack(given[number], np.uint8)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def line(self) -> np.ndarray:
        return _with_ends(self.classes[self.code], self.first)[0]


_NEAR = "range int, block long, a binary, b binary, c binary, d binary"
_GIVEN = "block long, kind int, range int, a binary, b binary"


def _neighbours(shared: Broadcast):
    """For each word of a block that is seen often, how many of its neighbours in training texts are of each class, by range of the words."""

    def neighbours(table: pa.Table) -> pa.Table:
        block, size, out = _Block(table, shared.value), shared.value.size, []
        line = block.line()
        number = np.full(len(block.counts), -1)
        words = np.concatenate([w for _, w, _ in block.middle]) if block.middle else np.zeros(0, np.int64)
        number[words] = np.arange(len(words))
        of, doc = number[block.code] if len(block.code) else np.zeros(0, np.int64), np.repeat(np.arange(len(block.n)), block.n)
        token = np.flatnonzero((of >= 0) & ~block.held_out[doc])
        place = token + doc[token] + 1
        key = np.concatenate([of[token] * 2 * size + line[place - 1], of[token] * 2 * size + size + line[place + 1]])
        key, n = np.unique(key, return_counts=True)
        begin = np.searchsorted(key, np.arange(len(words) + 1) * 2 * size)
        at = 0
        for r, own, hashes in block.middle:
            a, b = begin[at], begin[at + len(own)]
            if len(own):
                out.append((r, table.column("block")[0].as_py(), T.pack_sorted(hashes), T.pack(np.diff(begin[at : at + len(own) + 1]).astype(np.uint32)), T.pack((key[a:b] % (2 * size)).astype(np.uint16)), T.pack(n[a:b].astype(np.uint32))))
            at += len(own)
        columns = zip(*out) if out else [[]] * 6
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), *[pa.binary()] * 4))], names=["range", "block", "a", "b", "c", "d"])

    return neighbours


def best_classes(left: np.ndarray, right: np.ndarray, grid: np.ndarray, fixed: int = SHAPES + 1) -> np.ndarray:
    """For each word, the learned class that gains most from its neighbours' classes, the grid of class bigrams staying as it is."""
    rows, columns, n = grid.sum(1), grid.sum(0), right.sum(1)
    worth = np.empty((len(n), len(grid) - fixed))
    for b in range(fixed, len(grid)):
        gain = (_xlogx(grid[b] + right) - _xlogx(grid[b])).sum(1) + (_xlogx(grid[:, b] + left) - _xlogx(grid[:, b])).sum(1)
        worth[:, b - fixed] = gain - (_xlogx(rows[b] + n) - _xlogx(rows[b])) - (_xlogx(columns[b] + n) - _xlogx(columns[b]))
    return fixed + np.argmax(worth, axis=1)


def _assign(shared: Broadcast, step: int = 1024):
    """Moves a range's words to classes; tells blocks those of their words, and (kind 3) sums by class."""

    def assign(table: pa.Table) -> pa.Table:
        grid = shared.value.grid
        size = len(grid)
        rows = table.to_pylist()
        own = [(r, T.unpack_sorted(r["a"], np.uint64), T.unpack(r["b"], np.uint32), T.unpack(r["c"], np.uint16), T.unpack(r["d"], np.uint32)) for r in rows]
        every, back = np.unique(np.concatenate([h for _, h, _, _, _ in own]), return_inverse=True)
        word = np.repeat(back, np.concatenate([k for _, _, k, _, _ in own]))
        near, n = (np.concatenate([x[i] for x in own]).astype(np.int64) for i in (3, 4))
        order = np.argsort(word, kind="stable")
        word, near, n = word[order], near[order], n[order]
        classes, total = np.zeros(len(every), np.int64), np.zeros(size)
        for a in range(0, len(every), step):
            b = min(a + step, len(every))
            lo, hi = np.searchsorted(word, [a, b])
            counts = np.bincount((word[lo:hi] - a) * 2 * size + near[lo:hi], n[lo:hi], minlength=(b - a) * 2 * size).reshape(b - a, 2 * size)
            classes[a:b] = best_classes(counts[:, :size], counts[:, size:], grid)
            np.add.at(total, classes[a:b], counts[:, size:].sum(1))
        kinds, number, at, out = np.bincount(classes, minlength=size).astype(float), rows[0]["range"], 0, []
        for r, hashes, _, _, _ in own:
            out.append((r["block"], 4, number, T.pack(classes[back[at : at + len(hashes)]].astype(np.uint8)), b""))
            at += len(hashes)
        out.append((-1, 3, number, T.pack(total), T.pack(kinds)))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "kind", "range", "a", "b"])

    return assign


_READY = "kind int, a binary, b binary, c binary, d binary, e binary, f binary"


def _ready(shared: Broadcast):
    """A block with the classes of its words (kind 0), and its class bigrams in training texts (kind 1)."""

    def ready(table: pa.Table) -> pa.Table:
        block, size = _Block(table, shared.value), shared.value.size
        line = block.line()
        # Neighbours of one training text, its ends included.
        of = np.repeat(np.arange(len(block.n)), block.n + 1)
        learned = ~block.held_out[of]
        key, n = np.unique((line[:-1] * size + line[1:])[learned], return_counts=True)
        rows = [
            (0, *block.meta, T.pack(block.counts), T.pack(block.classes.astype(np.uint8))),
            (1, T.pack(key.astype(np.uint32)), T.pack(n.astype(np.int64)), None, None, None, None),
        ]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 6))], names=["kind", *"abcdef"])

    return ready


def _bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, int] = {}
    for batch in batches:
        for r in batch.to_pylist():
            for k, n in zip(T.unpack(r["a"], np.uint32).tolist(), T.unpack(r["b"], np.int64).tolist()):
                sums[k] = sums.get(k, 0) + n
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["pair", "n"])


def _score(shared: Broadcast):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ClassModel = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                yield _scores(model, batch.slice(i, 1).to_pylist()[0])
            T.hand_back()

    return score


def _scores(model: ClassModel, row: dict) -> pa.RecordBatch:
    doc, held_out, n = T.unpack(row["a"], np.int64), T.unpack(row["b"], np.uint8) > 0, T.unpack(row["c"], np.uint32).astype(np.int64)
    code, count, classes = T.unpack(row["d"], np.uint32), T.unpack(row["e"], np.uint64).astype(float), T.unpack(row["f"], np.uint8).astype(np.int64)
    emitted, plain = model.emission(count, classes), model.unigram(count)
    first = np.concatenate([[0], np.cumsum(n)])
    line, ends = _with_ends(classes[code], first)
    steps = np.concatenate([[0.0], np.cumsum(model.follows[line[:-1], line[1:]])])

    def summed(values: np.ndarray) -> np.ndarray:
        return np.array([values[code[a:b]].sum() for a, b in zip(first, first[1:])], float)

    known = summed((count > 0).astype(float)).astype(np.int64) + (model.texts > 0)
    return pa.RecordBatch.from_pydict(
        {
            "doc": doc, "held_out": held_out, "n_tokens": n + 1, "n_known": known, "train_tokens": np.full(len(doc), model.tokens, np.int64),
            "base_score": summed(plain) + model.unigram(model.texts), "score": summed(emitted) + np.diff(steps[ends]),
        }
    )


def fit_classes(docs: DataFrame, counted: DataFrame, texts: int, words: int) -> ClassModel:
    """The classes of frequent words of ``docs`` (those learned from), given the sums by range that ``counted`` has as its kind 2."""
    frequent, counts, total, kinds = [], [], np.zeros(SHAPES + 1), np.zeros(SHAPES + 1)
    for r in counted.filter("kind = 2").select("a", "b", "c", "d").toLocalIterator():
        frequent.append(T.unpack(r["a"], np.uint64))
        counts.append(T.unpack(r["b"], np.uint64))
        total[:SHAPES] += T.unpack(r["c"], np.uint64)
        kinds[:SHAPES] += T.unpack(r["d"], np.uint64)
    frequent, counts = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (frequent, counts))
    by = np.argsort(frequent)
    frequent, counts = frequent[by], counts[by].astype(float)
    order = np.empty(len(frequent), np.int64)
    order[np.lexsort((frequent, -counts))] = np.arange(len(frequent))
    size = SHAPES + 1 + len(frequent)
    pairs = np.zeros((size, size))
    found = docs.select("text").mapInArrow(_pairs(frequent, order), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for batch in found.toArrow().to_batches():  # at most size * size rows
        pairs.ravel()[batch.column("pair").to_numpy()] = batch.column("n").to_numpy()
    own = exchange(pairs)
    classes = max(int(own.max()) + 1, SHAPES + 2)  # one learned class at least
    grid = np.zeros((classes, classes))
    np.add.at(grid, (own[:, None], own[None, :]), pairs)
    total, kinds = (np.concatenate([x, np.zeros(classes - SHAPES - 1)]) for x in (total, kinds))
    np.add.at(total, own[SHAPES + 1 + order], counts)
    np.add.at(kinds, own[SHAPES + 1 + order], 1)
    return ClassModel(frequent, order, own, grid, total, kinds, texts, words)


def with_all_classes(model: ClassModel, grid: np.ndarray, given: DataFrame) -> ClassModel:
    """The model with all words in their classes: ``grid`` of their bigrams, and the sums by class of ``given`` (kind 3)."""
    total, kinds = model.total.copy(), model.kinds.copy()
    for r in given.toLocalIterator():
        total += T.unpack(r["a"], float)
        kinds += T.unpack(r["b"], float)
    return replace(model, grid=grid, total=total, kinds=kinds)


def score_texts(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id``, ``text``) by a model of those not ``held_out``.

    ``doc_id``, ``held_out``, ``n_tokens`` (words and an end), ``n_known`` (of them, those in training texts),
    ``train_tokens``, ``base_score`` (log10 probability by smoothed word counts), ``score`` (by classes), ``perplexity`` (of ``score``).

    Text is lower-cased (A-Z). A null or empty text has an end only. Equal rows get equal scores and are learned
    as often as they occur. With nothing to learn from, all words are unseen. ``docs`` must read alike
    each time (a stored table). No rows give no rows.
    """
    T.bound_batches(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = is_held_out(F.col("doc_id")) if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(out, F.lit(True)).alias("held_out"), "text")
    learned = ~F.col("held_out")
    sums = rows.agg(F.sum(F.octet_length("text")), F.count_if(learned), F.sum(F.when(learned, T.word_count("text")))).head()
    ranges = max(2 * partitions, (sums[0] or 0) // RANGE_BYTES)
    known = rows.withColumn("doc", F.coalesce("doc", F.lit(-(1 << 63))))
    sent = known.mapInArrow(_send(ranges), _SENT)
    counted = freeze(sent.groupBy("range").applyInArrow(_count(sums[2] or 0), _BACK))
    model = fit_classes(rows.filter(learned), counted, sums[1], sums[2] or 0)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)
    blocks = counted.filter("kind < 2")
    near = blocks.groupBy("block").applyInArrow(_neighbours(shared), _NEAR)
    given = freeze(near.groupBy("range").applyInArrow(_assign(shared), _GIVEN))
    back = given.filter("kind = 4").select("block", "kind", "range", "a", "b", *[F.lit(None).cast("binary").alias(c) for c in "cde"])
    ready = freeze(blocks.unionByName(back).groupBy("block").applyInArrow(_ready(shared), _READY))
    grid = np.zeros(model.size * model.size)
    found = ready.filter("kind = 1").select("a", "b").mapInArrow(_bigrams, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for r in found.toLocalIterator():  # at most as many as classes squared
        grid[r["pair"]] = r["n"]
    whole = context.broadcast(with_all_classes(model, grid.reshape(model.size, model.size), given.filter("kind = 3").select("a", "b")))
    scored = ready.filter("kind = 0").mapInArrow(_score(whole), _SCORED)
    return scored.select(
        F.when(F.col("doc") != -(1 << 63), F.col("doc")).alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
