"""Benchmark decontamination: passages of a corpus that hold a test item.

Test items are indexed by word. A word's weight in an item is its BM25 weight divided by the sum over
all of the item's words, so a score is the share of the item that a passage holds, 0 to 1, and one
threshold serves all items. Postings are kept in blocks with the largest weight of each.

Every document is cut into overlapping passages, long enough that any item lies whole in one of them,
and every passage is a query. An item's commonest words alone can't reach the threshold, so passages
with too little of its other words are left out at once; for the others, block-max WAND walks the postings
and skips blocks that can't reach the threshold. Each item found is then verified: enough of the question's and of
the answer's word pairs must occur in the passage. A guessed answer of few pairs has no test of its own; the item is then
verified as one text. Words are compared without the ASCII punctuation around them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze

#: Fixed values of BM25.
K1, B = 1.2, 0.75
#: Postings in a block.
BLOCK = 32
#: Bytes of item text that are looked for at a time; more items make more passes over the documents.
INDEX_BYTES = 8_000_000
#: A guessed answer of fewer word pairs is verified together with the question.
MIN_ANSWER_PAIRS = 5
_END = 1 << 60


@dataclass(frozen=True)
class Limits:
    """What makes a passage count as one that holds an item."""

    min_share: float = 0.5  # of the item's BM25 weight
    min_question: float = 0.5  # of the question's word pairs
    min_answer: float = 0.5  # of the answer's word pairs
    min_words: int = 8  # items with fewer words are looked for as they are


@dataclass
class Postings:
    """The items that hold a word, rising, with their weights, and each block's last item and largest weight."""

    items: list[int]
    weights: list[float]
    last: list[int]
    top: list[float]
    most: float


@dataclass
class Statistics:
    """What weights are taken from, over all items: their number, mean length, and how many hold each word."""

    n: int
    mean: float
    held: dict[int, int]

    @classmethod
    def of(cls, counts: list[Counter]) -> Statistics:
        return cls(len(counts), sum(sum(c.values()) for c in counts) / max(1, len(counts)), Counter(w for c in counts for w in c))


class Index:
    """Items by word. ``items`` are ``(id, question, answer)``, the texts as bytes; weights are by ``statistics`` of all items there are."""

    def __init__(self, items: list[tuple[int, bytes, bytes]], limits: Limits = Limits(), statistics: Statistics | None = None, half: int | None = None):
        self.limits, self.ids, self.parts = limits, [], []
        counts = []
        for item, question, answer in items:
            asked, answered = _hashes(question), _hashes(answer)
            words = np.concatenate([asked, answered])
            if len(words) >= limits.min_words:
                self.ids.append(item)
                self.parts.append((pairs(asked), pairs(answered)))
                counts.append(Counter(words.tolist()))
        self.half = max((sum(c.values()) for c in counts), default=0) if half is None else half  # of a passage, in words
        told = Statistics.of(counts) if statistics is None else statistics
        mean = told.mean
        idf = {w: math.log(1 + (told.n - told.held[w] + 0.5) / (told.held[w] + 0.5)) for c in counts for w in c}
        lists: dict[int, list[tuple[int, float]]] = {}
        for i, c in enumerate(counts):
            size = sum(c.values())
            weight = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * size / mean)) for w, n in c.items()}
            whole = sum(weight.values())
            for w, x in weight.items():
                lists.setdefault(w, []).append((i, x / whole))
        self.postings = {}
        for w, held_by in lists.items():
            items_, weights = [i for i, _ in held_by], [x for _, x in held_by]
            blocks = range(0, len(items_), BLOCK)
            self.postings[w] = Postings(
                items_, weights, [items_[min(b + BLOCK, len(items_)) - 1] for b in blocks], [max(weights[b : b + BLOCK]) for b in blocks], max(weights)
            )
        self._split(lists, idf, len(counts))

    def _split(self, lists: dict[int, list[tuple[int, float]]], idf: dict[int, float], n: int) -> None:
        """Sets each item's commonest words apart, as many as make up to half of the least share.

        The others are its essential words: a passage with too few of them can't reach the threshold.
        """
        self.rest, essential = np.zeros(n), []
        for w in sorted(lists, key=lambda w: (idf[w], w)):
            for i, x in lists[w]:
                if self.rest[i] + x <= self.limits.min_share / 2:
                    self.rest[i] += x
                else:
                    essential.append((w, i, x))
        essential.sort()
        self.known, first = np.unique(np.array([w for w, _, _ in essential], np.uint64), return_index=True)
        self.first = np.append(first, len(essential))
        self.item = np.array([i for _, i, _ in essential], np.int64)
        self.weight = np.array([x for _, _, x in essential], float)
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Where each word is among the essential words, -1 if it is not."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[place] == hashes, place, -1)

    def likely(self, passage: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        """Passages that may reach the threshold for some item, given the essential words in each.

        First by the largest weight of each word, then by item for those that are left.
        """
        least = self.limits.min_share - 1e-9
        bound = np.bincount(passage, self.most[word], minlength=n)
        left = bound[passage] >= least - self.rest.max(initial=0.0)
        passage, word = passage[left], word[left]
        held = self.first[word + 1] - self.first[word]
        at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(self.first[word], held)
        key, back = np.unique(np.repeat(passage, held) * max(1, len(self.rest)) + self.item[at], return_inverse=True)
        reached = np.bincount(back, self.weight[at], minlength=len(key)) + self.rest[key % max(1, len(self.rest))] >= least
        return np.unique(key[reached] // max(1, len(self.rest)))

    def above(self, query: set[int], least: float) -> list[tuple[int, float]]:
        """All items of which the words of ``query`` hold at least ``least``, by block-max WAND."""
        cursors = [[p.items[0], 0, p] for w in query if (p := self.postings.get(w))]
        found = []
        slack = least - 1e-9
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2].most
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            here, until = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else _END
            for c in cursors[: pivot + 1]:  # what the blocks that would hold the item can reach
                p, block = c[2], c[1] // BLOCK
                while block < len(p.last) and p.last[block] < item:
                    block += 1
                if block < len(p.last):
                    here += p.top[block]
                    until = min(until, p.last[block] + 1)
            if here < slack:
                target = max(until, item + 1)
            elif cursors[0][0] == item:
                score = sum(c[2].weights[c[1]] for c in cursors[: pivot + 1])
                if score >= slack:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    at, p = c[1], c[2]
                    while at < len(p.items) and p.items[at] < target:
                        block = at // BLOCK
                        at = (block + 1) * BLOCK if p.last[block] < target else at + 1
                    c[0], c[1] = (p.items[at], at) if at < len(p.items) else (_END, at)
            cursors = [c for c in cursors if c[0] < _END]
        return found


class Sequences:
    """Items of few words, as the hashes of their word sequences, by their number of words."""

    def __init__(self, items: list[tuple[int, bytes, bytes]], limits: Limits):
        self.ids, by = [], {}
        for item, question, answer in items:
            words = np.concatenate([_hashes(question), _hashes(answer)])
            if 0 < len(words) < limits.min_words:
                by.setdefault(len(words), []).append((int(T.run_hashes(words, len(words))[0]), len(self.ids)))
                self.ids.append(item)
        self.by = {n: (np.array([h for h, _ in sorted(held)], np.uint64), np.array([i for _, i in sorted(held)])) for n, held in by.items()}

    def found(self, words: T.Words, hashes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``(text, item, start, words)`` where an item's words follow each other in a text, the first place of each."""
        for n, (known, items) in self.by.items():
            runs = T.run_hashes(hashes, n)
            low, high = np.searchsorted(known, runs), np.searchsorted(known, runs, "right")
            seen = set()
            for at in np.flatnonzero((low < high) & words.spans(n)).tolist():
                doc = int(np.searchsorted(words.first, at, "right")) - 1
                for item in items[low[at] : high[at]].tolist():
                    if (doc, item) not in seen:
                        seen.add((doc, item))
                        yield doc, item, at - int(words.first[doc]), n


@dataclass
class Items:
    """The items of one pass: an index for each class of lengths, so that a passage fits its items, and short ones as sequences."""

    indexes: list[Index]
    sequences: Sequences

    def hits(self, texts: list[bytes | None]) -> dict[tuple[int, int, int], tuple]:
        """By text, index and item: the item's id, and the best passage (see ``_hits``)."""
        words = T.words_of(texts, lower=True).stripped()
        hashes, rows = words.hashes(), {}
        for k, index in enumerate(self.indexes):
            for (doc, item), found in _hits(index, words, hashes).items():
                rows[doc, k, item] = (index.ids[item], *found)
        for doc, item, start, n in self.sequences.found(words, hashes):
            rows[doc, -1, item] = (self.sequences.ids[item], start, 1.0, n, 1.0, 1.0)
        return rows


def _hashes(text: bytes) -> np.ndarray:
    return T.words_of([text], lower=True).stripped().hashes()


def pairs(hashes: np.ndarray) -> set[int]:
    """Neighbouring words as one hash each; a single word stands for itself."""
    return set((T.run_hashes(hashes, 2) if len(hashes) > 1 else hashes).tolist())


def _share(part: set[int], held: set[int]) -> float:
    return len(part & held) / len(part) if part else 1.0


_HIT_SCHEMA = "doc_id long, text_key long, item_id long, start int, words int, score double, question double, answer double"


def _last_before(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where each word occurred last before in its document, -1 if it did not."""
    key = T.mix(hashes + doc.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    before = np.full(len(key), -1)
    same = key[order[1:]] == key[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    return before


def _hits(index: Index, words: T.Words, hashes: np.ndarray) -> dict[tuple[int, int], tuple]:
    """By text and item, the best passage: its start, score, number of words, and shares of question and answer."""
    limits, half = index.limits, max(1, index.half)
    n = np.diff(words.first)
    # A passage is two neighbouring halves. Its bound counts each word once.
    passages = np.maximum(1, -(-n // half) - 1)
    doc = np.repeat(np.arange(len(n)), passages)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(passages) - passages, passages)
    begin = words.first[doc] + nth * half
    end = np.minimum(begin + 2 * half, words.first[doc + 1])
    word = index.lookup(hashes)
    at = np.flatnonzero(word >= 0)
    before = _last_before(hashes[at], words.doc[at])
    before = np.where(before >= 0, at[before], -1) if len(at) else at
    # An essential word lies in the passages of its half and of the half before.
    half_of = (at - words.first[words.doc[at]]) // half
    spots = []
    for back in (0, 1):
        nth_of = half_of - back
        ok = (nth_of >= 0) & (nth_of < passages[words.doc[at]])
        passage = (np.cumsum(passages) - passages)[words.doc[at[ok]]] + nth_of[ok]
        fresh = before[ok] < begin[passage]
        spots.append((passage[fresh], word[at[ok][fresh]]))
    likely = index.likely(*(np.concatenate(x) for x in zip(*spots)), len(doc))
    rows: dict[tuple[int, int], tuple] = {}
    for k in likely:
        own = hashes[begin[k] : end[k]]
        hits = index.above(set(own.tolist()), limits.min_share)
        held = pairs(own) | set(own.tolist()) if hits else set()
        for item, score in hits:
            asked, answered = (_share(part, held) for part in index.parts[item])
            key = (int(doc[k]), item)
            if asked >= limits.min_question and answered >= limits.min_answer and (key not in rows or rows[key][1] < score):
                rows[key] = (int(nth[k]) * half, score, int(end[k] - begin[k]), asked, answered)
    return rows


def _search(shared: Broadcast):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batches):
            rows = shared.value.hits(T.raw(chunk.column("text")))
            if rows:
                at = pa.array([d for d, _, _ in rows], pa.int64())
                ids, start, score, words, asked, answered = zip(*rows.values())
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id").take(at), chunk.column("text_key").take(at), pa.array(ids, pa.int64()),
                        pa.array(start, pa.int32()), pa.array(words, pa.int32()), pa.array(score, pa.float64()), pa.array(asked, pa.float64()), pa.array(answered, pa.float64()),
                    ],
                    names=["doc_id", "text_key", "item_id", "start", "words", "score", "question", "answer"],
                )

    return search


def _clean(shared: Broadcast):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batches):
            kept = np.ones(chunk.num_rows, bool)
            kept[[d for d, _, _ in shared.value.hits(T.raw(chunk.column("text")))]] = False
            yield chunk.filter(pa.array(kept))

    return clean


def question_and_answer(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, question, answer, guessed)`` of items that are one text: the answer is its last sentence, if there are two."""
    last = F.regexp_extract(F.rtrim(text), r"(?s)^(.*[.!?]\s)(.+)$", 2)
    first = F.regexp_extract(F.rtrim(text), r"(?s)^(.*[.!?]\s)(.+)$", 1)
    return items.select(F.col(item_id).alias("item_id"), F.when(first == "", F.col(text)).otherwise(first).alias("question"), last.alias("answer"), F.lit(True).alias("guessed"))


def find_items(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The test items that each document holds.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id``, ``question`` and ``answer``, and ``guessed``
    where answers may be a guess (``MIN_ANSWER_PAIRS``; such an item's ``answer`` share is 1). Items are looked for in parts of
    at most ``index_bytes`` of text (or one item), each small enough for every task; all documents pass each. Weights are by the
    statistics of all items, and a passage is as long as items of about one length ask, so what is found does not depend on the parts.

    One row for each document and item found: ``doc_id``, ``text_key`` (a hash of the text), ``item_id``, the passage's
    ``start`` and ``words``, ``score``, and the shares of ``question`` and ``answer`` pairs it holds. Items of fewer than ``limits.min_words`` words are found
    where their words follow each other, with a score and shares of 1. Items without words are never found, nor is anything in a null or empty text. Repeated items and documents
    are found each. No items or documents give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    out = spark.createDataFrame([], _HIT_SCHEMA)
    for part in _indexed(items, limits, index_bytes):
        out = out.unionByName(rows.mapInArrow(_search(spark.sparkContext.broadcast(part)), _HIT_SCHEMA))
    return out


def _length(words: int) -> int:
    """The class of an item's length: up to two to its power."""
    return max(words - 1, 0).bit_length()


def _words_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different words of each item, and (word null) how many words it has."""
    for batch in batches:
        held, sizes = [], []
        for question, answer in zip(T.raw(batch.column("question")), T.raw(batch.column("answer"))):
            words = np.concatenate([_hashes(question or b""), _hashes(answer or b"")])
            sizes.append(len(words))
            held.append(np.unique(words).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int64()))], names=["size", "words"])


def _indexed(items: DataFrame, limits: Limits, index_bytes: int) -> Iterator[Items]:
    """The items in parts of bounded size, each with the statistics of its words over all items."""
    spark, told = items.sparkSession, None
    for part in _parts(items, index_bytes):
        counts = [Counter(np.concatenate([_hashes(q), _hashes(a)]).tolist()) for _, q, a in part]
        long = [i for i, c in enumerate(counts) if sum(c.values()) >= limits.min_words]
        if told is None:
            sized = freeze(items.select("question", "answer").mapInArrow(_words_held, "size long, words array<long>").filter(F.col("size") >= limits.min_words))
            n, mean = sized.agg(F.count(F.lit(1)), F.avg("size")).head()
            told = freeze(sized.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
        # As many words as the part has at most.
        own = spark.createDataFrame([(w,) for w in set(np.array([w for i in long for w in counts[i]], np.uint64).view(np.int64).tolist())], "word long")
        held = {r["word"] % 2**64: r["n"] for r in told.join(F.broadcast(own), "word").toLocalIterator()}
        by: dict[int, list] = {}
        for i in long:
            by.setdefault(_length(sum(counts[i].values())), []).append(part[i])
        indexes = [Index(group, limits, Statistics(n, mean, held), 1 << length) for length, group in sorted(by.items())]
        sequences = Sequences(part, limits)
        if indexes or sequences.ids:
            yield Items(indexes, sequences)


def _parts(items: DataFrame, index_bytes: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """The items in lists of bounded size; one list at a time is on the driver."""
    part, size = [], 0
    guessed = F.col("guessed") if "guessed" in items.columns else F.lit(False).alias("guessed")
    for row in items.select("item_id", "question", "answer", guessed).toLocalIterator():
        question, answer = (row["question"] or "").encode(), (row["answer"] or "").encode()
        if row["guessed"] and len(pairs(_hashes(answer))) < MIN_ANSWER_PAIRS:
            question, answer = question + b" " + answer, b""
        if part and size + len(question) + len(answer) > index_bytes:
            yield part
            part, size = [], 0
        part.append((row["item_id"], question, answer))
        size += len(question) + len(answer)
    if part:
        yield part


def drop_contaminated(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold none of the items, as they are. Rows are not moved."""
    for part in _indexed(items, limits, index_bytes):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(part)), docs.schema)
    return docs
