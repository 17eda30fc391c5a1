"""Quality rules: simple counts, and how far a text's make-up is from its language's.

Two histograms describe a text: its characters by class, and its words by which common word
they are (or none). Each is compared with the same histogram over all texts of the language by
the Jensen-Shannon distance (base 2, so 0 to 1). Short texts have rough histograms, so each
comparison has a least length, below which it does not count against a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze

SYMBOLS = b"#*$%&|<>"
CLASSES = ["lower", "upper", "digit", "space", "line_end", "stop", "symbol", "control", "beyond_ascii"]


@dataclass(frozen=True)
class Limits:
    """When a text is refused."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: A word is common in a language if it is at least one in so many; so there are at most as many.
    common_share: int = 400
    min_chars_compared: int = 200
    max_char_distance: float = 0.31
    min_words_compared: int = 50
    max_word_distance: float = 0.33
    #: A histogram of few words strays: a text of n words may be farther by this over the root of n.
    word_noise: float = 0.6


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("control"), np.uint8)
    for name, held in (
        ("stop", range(33, 127)), ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
        ("space", (9, 32)), ("line_end", (10,)), ("symbol", SYMBOLS), ("beyond_ascii", range(192, 256)),
    ):
        table[list(held)] = CLASSES.index(name)
    table[128:192] = len(CLASSES)  # the rest of a character that began before
    return table


_CLASS = _class_table()
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def _within(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set from each position to the next."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[np.minimum(at, len(flags))])


def _class_counts(words: T.Words) -> list[np.ndarray]:
    """Characters by class of each text."""
    classes, at = _CLASS[words.buffer], words.at
    return [np.bincount(classes[a : b - 1], minlength=len(CLASSES) + 1)[: len(CLASSES)] for a, b in zip(at, at[1:])]


def _repeat_words(words: T.Words) -> np.ndarray:
    """Words of each text in three-word windows that it holds twice or more."""
    doc = words.doc
    key = T.run_hashes(words.hashes(), 3)
    key = T.mix(key + doc[: len(key)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(words.spans(3))
    order = at[np.argsort(key[at])]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    held = np.zeros(len(doc), bool)
    for k in range(3):
        held[twice + k] = True
    return _within(held, words.first)


def _dup_lines(text: bytes | None) -> int:
    seen, found = set(), 0
    for line in (text or b"").split(b"\n"):
        if line in seen:
            found += bool(line.strip())
        else:
            seen.add(line)
    return found


_COUNTED = "lang string, counts array<long>"


def _count_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in T.chunks(batches):
        sums: dict[str | None, np.ndarray] = {}
        for lang, counts in zip(chunk.column("lang").to_pylist(), _class_counts(T.words_of(T.raw(chunk.column("text"))))):
            sums[lang] = sums.get(lang, 0) + counts
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(sums), pa.string()), "counts": pa.array([c.tolist() for c in sums.values()], pa.list_(pa.int64()))}
        )


def language_references(docs: DataFrame, limits: Limits = Limits(), lang: str = "lang", text: str = "text") -> list[dict]:
    """The make-up of each language over all its texts: character classes, and common words with their counts.

    A language has at most ``limits.common_share`` common words, so the result is bounded by the
    number of languages. Texts without a language form one of their own.
    """
    T.bound_batches(docs.sparkSession)
    docs = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    classes = docs.mapInArrow(_count_classes, _COUNTED).select("lang", F.posexplode("counts"))
    classes = classes.groupBy("lang", "pos").agg(F.sum("col").alias("n")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("classes"))
    counted = docs.select("lang", F.explode(F.regexp_extract_all(T.lowered("text"), F.lit(T.WORD), F.lit(0))).alias("word")).groupBy("lang", "word").count()
    counted = freeze(counted)
    totals = F.broadcast(counted.groupBy("lang").agg(F.sum("count").alias("total")))  # one row per language
    common = counted.alias("c").join(totals.alias("t"), F.col("c.lang").eqNullSafe(F.col("t.lang")))
    common = common.filter(F.col("count") * limits.common_share >= F.col("total")).groupBy("c.lang", "total")
    common = common.agg(F.sort_array(F.collect_list(F.struct("word", "count"))).alias("common"))
    words = {r["lang"]: r for r in common.collect()}
    return [
        {
            "lang": r["lang"],
            "classes": [c["n"] for c in r["classes"]],
            "words": (found := {c["word"]: c["count"] for c in words[r["lang"]]["common"]} if r["lang"] in words else {}),
            "others": (words[r["lang"]]["total"] if r["lang"] in words else 0) - sum(found.values()),
        }
        for r in classes.collect()
    ]


_JUDGED = (
    "doc_id long, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "char_distance double, word_distance double, base_failed boolean, kept boolean"
)


class Judge:
    """Judges texts by references and limits, both small."""

    def __init__(self, references: list[dict], limits: Limits):
        self.limits = limits
        self.chars = {r["lang"]: np.array(r["classes"], float) for r in references}
        self.common = {}
        for r in references:
            hashed = T.words_of([w.encode() for w in r["words"]]).hashes()
            order = np.argsort(hashed)
            counts = np.array([*r["words"].values(), r["others"]], float)
            self.common[r["lang"]] = (hashed[order], np.append(counts[:-1][order], counts[-1]))

    def word_distance(self, hashes: np.ndarray, lang: str | None) -> float:
        known, reference = self.common[lang]
        place = np.searchsorted(known, hashes)
        hit = known[np.minimum(place, len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)
        return js_distance(np.bincount(np.where(hit, place, len(known)), minlength=len(known) + 1), reference)

    def verdicts(self, texts: list[bytes | None], langs: list[str | None]) -> dict[str, np.ndarray]:
        limits, words = self.limits, T.words_of(texts)
        n_words, repeat = np.diff(words.first), _repeat_words(words)
        begins = (words.buffer & 0xC0) != 0x80
        hashes = T.words_of(texts, lower=True).hashes()
        far = np.zeros((2, len(texts)))
        for i, (lang, counts) in enumerate(zip(langs, _class_counts(words))):
            if lang in self.chars and counts.sum() >= limits.min_chars_compared:
                far[0, i] = js_distance(counts, self.chars[lang])
            if lang in self.common and n_words[i] >= limits.min_words_compared:
                far[1, i] = self.word_distance(hashes[words.first[i] : words.first[i + 1]], lang)
        failed = (n_words < limits.min_words) | (100 * repeat > limits.max_repeat_percent * n_words)
        close = far[1] <= limits.max_word_distance + limits.word_noise / np.sqrt(np.maximum(n_words, 1))
        return {
            "n_words": n_words.astype(np.int64), "word_chars": _within(begins & ~T.is_space(words.buffer), words.at),
            "n_symbols": _within(_IS_SYMBOL[words.buffer], words.at), "n_dup_lines": np.array([_dup_lines(t) for t in texts], np.int64),
            "n_repeat_words": repeat, "char_distance": far[0], "word_distance": far[1],
            "base_failed": failed, "kept": ~failed & (far[0] <= limits.max_char_distance) & close,
        }


def judge_quality(docs: DataFrame, limits: Limits = Limits(), references: list[dict] | None = None) -> DataFrame:
    """Counts and verdict of every document; ``docs`` has ``doc_id``, ``text`` and ``lang``.

    One row per row of ``docs``: ``doc_id``, ``text_key`` (a hash of the text), ``n_words``, ``word_chars``
    (characters in words), ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``char_distance`` and
    ``word_distance`` (0 where a text is too short to compare), ``base_failed`` and ``kept``.

    A null or empty text has no words, so it fails for length. A null language is a language. Equal
    rows get equal verdicts. No rows give no rows. Other columns do not matter.
    """
    made = Judge(language_references(docs, limits) if references is None else references, limits)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batches):
            found = made.verdicts(T.raw(chunk.column("text")), chunk.column("lang").to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": chunk.column("doc_id"), "text_key": chunk.column("text_key"), **found})

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text", "lang")
    return rows.mapInArrow(judge, _JUDGED)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, as they are. Rows are not moved."""
    made = Judge(language_references(docs, limits), limits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batches):
            yield chunk.filter(pa.array(made.verdicts(T.raw(chunk.column("text")), chunk.column("lang").to_pylist())["kept"]))

    return docs.mapInArrow(keep, docs.schema)
