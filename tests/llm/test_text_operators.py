"""Operators on whole texts against plain answers, on odd texts and on supplied ones."""

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pytest
from harkline.llm import classlm, jaccard, lines, quality, repeats
from harkline.llm import text as T
from harkline.operators.frozen import freeze
from __spark_entry__ import queries

LAST = 1 << 63


def rows_of(sf):
    frame = pd.read_parquet(f"{sf}/documents.parquet")
    return list(zip(frame.doc_id.tolist(), frame.text.tolist()))


def test_words_are_what_the_pattern_says(odd_rows):
    texts = [t for _, t in odd_rows]
    words = T.words_of([None if t is None else t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert [words.word(k).decode() for k in range(words.first[i], words.first[i + 1])] == brute.words(t)
    hashes = {}
    for k, h in enumerate(words.hashes().tolist()):
        assert hashes.setdefault(words.word(k), h) == h
    assert len(set(hashes.values())) == len(hashes)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 18, 20])
def test_runs_of_words_have_one_hash_each(n):
    h = np.random.default_rng(n).integers(0, 3, 400).astype(np.uint64)
    runs = T.run_hashes(h, n)
    seen = {}
    for i, r in enumerate(runs.tolist()):
        assert seen.setdefault(tuple(h[i : i + n]), r) == r
    assert len(runs) == 401 - n and len(set(runs.tolist())) == len(seen)


def test_packed_numbers_come_back():
    for dtype in (np.int64, np.uint32, np.uint8):
        values = np.array([0, 1, 5, 5, 200], dtype)
        assert (T.unpack(T.pack(values), dtype) == values).all()
    assert (T.unpack_sorted(T.pack_sorted(np.array([3, 9, 2**47], np.uint64)), np.uint64) == [3, 9, 2**47]).all()
    assert len(T.unpack(T.pack(np.zeros(0, np.int64)), np.int64)) == 0


# Substring dedup


def substring_result(df):
    return sorted(((r["doc_id"] is None, r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept"])) for r in df.collect()), key=repr)


def test_substring_dedup(odd_docs, odd_rows):
    docs = [(LAST if d is None else d, t) for d, t in odd_rows]
    want = brute.substring_dedup(docs)
    expected = sorted(((d is None, d, *want[LAST if d is None else d, t]) for d, t in odd_rows), key=repr)
    assert substring_result(repeats.drop_repeats(odd_docs)) == expected


def test_substring_dedup_of_supplied_texts(spark, sf):
    want = {k[0]: v for k, v in brute.substring_dedup(rows_of(sf)).items()}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries()["op2_substring_dedup"](spark, sf).collect()}
    assert got == want


def test_equal_hashes_of_unequal_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(repeats, "_window_hashes", lambda ids: np.zeros(len(ids) - repeats.WINDOW + 1, np.uint64))
    ids = np.array([*range(25), *range(25), *range(100, 125)], np.int32)
    at = np.array([0, 1, 25, 26, 50])
    hit = repeats.repeated_windows(ids, at, (np.array([1, 1, 2, 2, 3]), np.array([0, 1, 0, 1, 0])))
    assert hit.tolist() == [False, False, True, True, False]


# Quality rules


def test_quality_counts(odd_docs, odd_rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted(((r["doc_id"], *[r[n] for n in names]) for r in quality.judge_quality(odd_docs).collect()), key=repr)
    assert got == sorted(((d, *brute.quality_counts(t)) for d, t in odd_rows), key=repr)


def test_quality_counts_of_supplied_texts(spark, sf):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in queries()["op3_quality_rules"](spark, sf).collect()}
    assert got == {d: brute.quality_counts(t) for d, t in rows_of(sf)}


def test_quality_references_and_distances(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frame = pd.read_parquet(f"{sf}/documents.parquet")
    references = {r["lang"]: r for r in quality.language_references(docs)}
    assert set(references) == set(frame.lang)
    for lang, own in frame.groupby("lang"):
        counts = Counter(w for t in own.text for w in brute.words(brute.lowered(t)))
        total = sum(counts.values())
        assert references[lang]["words"] == {w: n for w, n in counts.items() if n * 400 >= total}
        assert references[lang]["others"] == total - sum(references[lang]["words"].values())
        assert sum(references[lang]["classes"]) == sum(map(len, own.text))
    judged = {r["doc_id"]: r for r in quality.judge_quality(docs).collect()}
    row = frame[frame.text.str.split().str.len() > 200].iloc[0]
    common = list(references[row.lang]["words"])
    own = Counter(w for w in brute.words(brute.lowered(row.text)))
    p = np.array([*[own[w] for w in common], sum(own.values()) - sum(own[w] for w in common)], float)
    q = np.array([*references[row.lang]["words"].values(), references[row.lang]["others"]], float)
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    expected = math.sqrt(sum(x * math.log2(x / y) for a in (p, q) for x, y in zip(a, m) if x) / 2)
    assert judged[row.doc_id]["word_distance"] == pytest.approx(expected)


def test_quality_keeps_rows_as_they_are(odd_docs, no_docs):
    kept = {r["doc_id"] for r in quality.judge_quality(odd_docs).filter("kept").collect()}
    left = quality.keep_good(odd_docs)
    assert left.schema == odd_docs.schema and {r["doc_id"] for r in left.collect()} == kept and 25 < len(kept)
    assert quality.keep_good(no_docs).count() == 0


def test_quality_knows_labelled_junk(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality.judge_quality(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    judged = judged[~judged.base_failed].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert judged[judged.quality == 1].kept.mean() > 0.99
    assert judged[judged.quality == 0].kept.mean() < 0.2


# N-gram Jaccard join


def test_jaccard_components(odd_docs, odd_rows):
    numbered = [(i, t) for i, (_, t) in enumerate(odd_rows)]
    links = brute.jaccard_links(numbered)
    # Rows with one id are linked as their texts are.
    found = brute.components(links, [i for i, _ in numbered])
    smallest = {}
    for i, (d, _) in enumerate(odd_rows):
        key = LAST if d is None else d
        smallest[found[i]] = min(smallest.get(found[i], LAST), key)
    want = sorted(((d, len(brute.shingles(t)), None if smallest[found[i]] == LAST else smallest[found[i]]) for i, (d, t) in enumerate(odd_rows)), key=repr)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(odd_docs).collect()), key=repr)
    assert got == want


def test_jaccard_components_of_supplied_texts(spark, sf):
    docs = rows_of(sf)
    component = brute.components(brute.jaccard_links(docs), [d for d, _ in docs])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries()["op5_ngram_jaccard"](spark, sf).collect()}
    assert got == {d: (len(brute.shingles(t)), component[d]) for d, t in docs}


def test_jaccard_with_shingles_that_many_share(spark, tmp_path):
    """Chains, and a passage in every document, with the lists of common shingles kept apart."""
    import random

    from conftest import sentence

    rng = random.Random(3)
    common, rows = sentence(rng, 40), []
    for f in range(4):
        words = sentence(rng, 60).split()
        for _ in range(12):  # each a step from the one before
            words[rng.randrange(60)] = f"y{rng.random()}"
            rows.append((rng.randrange(10**9), f"{common} {' '.join(words)}"))
    rows += [(rng.randrange(10**9), f"{common} {sentence(rng, rng.choice([5, 10, 12, 100]))}") for _ in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    component = brute.components(brute.jaccard_links(rows), [d for d, _ in rows])
    assert len(set(component.values())) < len(rows) - 10
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.read.parquet(str(tmp_path / "d")), most=3).collect()}
    assert got == component


def test_jaccard_keeps_one_of_each(odd_docs):
    left = jaccard.keep_one_of_each(odd_docs)
    assert left.schema == odd_docs.schema
    ids = [r["doc_id"] for r in left.collect()]
    assert 3 in ids and not {5, 70, 71, 80, 91} & set(ids) and {120, 121, 122, 130} <= set(ids)
    assert ids.count(141) == 2


# Line dedup


def test_line_dedup(odd_docs, odd_rows):
    docs = [(LAST if d is None else d, t) for d, t in odd_rows]
    sure, least = brute.line_runs(docs, lines.SURE_LINES), brute.line_runs(docs, lines.MIN_LINES)
    removed = 0
    for r in lines.dedup_lines(odd_docs).collect():
        doc, text = r["row"]["doc_id"], r["row"]["text"]
        key = (LAST if doc is None else doc, text)
        assert len(sure[key]) <= r["lines_removed"] <= len(least[key])
        own = [x for x in (text or "").split("\n") if brute.words(x)]
        assert r["line_count"] == len(own)
        left = [x for x in (r["text"] or "").split("\n") if brute.words(x)]
        assert len(left) == len(own) - r["lines_removed"]
        assert r["lines_removed"] or r["text"] == text
        assert not (Counter(x for i, x in enumerate(own) if i not in least[key]) - Counter(left))
        assert not (Counter(left) - Counter(x for i, x in enumerate(own) if i not in sure[key]))
        removed += r["lines_removed"]
    assert removed > 10


def test_line_dedup_of_supplied_texts(spark, sf):
    docs = rows_of(sf)
    sure, least = brute.line_runs(docs, lines.SURE_LINES), brute.line_runs(docs, lines.MIN_LINES)
    for r in queries()["op7_line_dedup"](spark, sf).collect():
        text = dict(docs)[r["doc_id"]]
        assert len(sure[r["doc_id"], text]) <= r["lines_removed"] <= len(least[r["doc_id"], text])
        if not r["lines_removed"]:
            assert r["kept_sha256"] == brute.sha(text)


def plain_line_runs(docs):
    """Lines of runs with an earlier place: of three lines, or of one or two that have twenty words."""
    gone = {k: set(v) for k, v in brute.line_runs(docs, 3).items()}
    for n in (1, 2):
        for (d, t), held in brute.line_runs(docs, n).items():
            own = [len(brute.words(x)) for x in (t or "").split("\n") if brute.words(x)]
            long = [a for a in range(len(own) - n + 1) if sum(own[a : a + n]) >= 20]
            first = {a for a in long if set(range(a, a + n)) <= held}
            gone[d, t] |= {a + k for a in first if _has_earlier(docs, d, t, a, n) for k in range(n)}
    return gone


def _has_earlier(docs, d, t, a, n):
    lines_of = lambda x: [tuple(brute.words(y)) for y in (x or "").split("\n") if brute.words(y)]
    run = lines_of(t)[a : a + n]
    return any((e, b) < (d, a) and own[b : b + n] == run for e, u in docs for own in [lines_of(u)] for b in range(len(own) - n + 1))


def test_line_dedup_is_exact(odd_docs, odd_rows):
    docs = [(LAST if d is None else d, t) for d, t in odd_rows]
    want = plain_line_runs(docs)
    for r in lines.dedup_lines(odd_docs).collect():
        doc, text = r["row"]["doc_id"], r["row"]["text"]
        assert r["lines_removed"] == len(want[LAST if doc is None else doc, text]), doc


def test_short_runs_of_lines_are_found(spark, tmp_path):
    """Planted runs of one, two and three lines go; one or two lines of few words stay."""
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    planted = {
        "one": [words("a", 20)], "two": [words("b", 9), words("c", 11)], "three": ["d e", "f", "g h i"],
        "short": [words("j", 19)], "short pair": [words("k", 9), words("l", 10)],
    }
    rows = []
    for n, run in enumerate(planted.values()):
        for copy in range(3):
            own = [[f"{side} {n} {copy} {i}" for i in range(4)] for side in ("x", "y")]
            rows.append((10 * n + copy, "\n".join([*own[0], *run, *own[1]])))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    gone = {r["row"]["doc_id"]: r["lines_removed"] for r in lines.dedup_lines(spark.read.parquet(str(tmp_path / "d"))).collect()}
    lost = {"one": 1, "two": 2, "three": 3, "short": 0, "short pair": 0}
    assert gone == {10 * n + copy: lost[name] if copy else 0 for n, name in enumerate(planted) for copy in range(3)}


def test_fingerprints_are_window_minima():
    h = np.random.default_rng(2).integers(0, 2**63, 50).astype(np.uint64)
    places = lines.fingerprints(h)
    pairs = T.run_hashes(h, lines.LINES)
    assert {int(np.argmin(pairs[i : i + lines.WINDOW])) + i for i in range(len(pairs) - lines.WINDOW + 1)} == set(places.tolist())
    assert np.diff(places).max() <= lines.WINDOW
    assert len(lines.fingerprints(h[:1])) == 0 and len(lines.fingerprints(h[:2])) == 1


def test_line_dedup_keeps_columns(odd_docs, no_docs):
    left = lines.drop_repeated_lines(odd_docs)
    assert left.columns == odd_docs.columns
    ids = {r["doc_id"] for r in left.collect()}
    assert {120, 121, 122, 123} <= ids
    assert lines.drop_repeated_lines(no_docs).count() == 0


# Class-based scores


def base_scores(docs):
    learned = Counter()
    for d, t in docs:
        if zlib.crc32(str("" if d is None else d).encode()) % 10:
            learned.update([*brute.words(brute.lowered(t)), None])
    n, v = sum(learned.values()), len(learned)
    for d, t in docs:
        tokens = [*brute.words(brute.lowered(t)), None]
        score = sum(math.log10((learned[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        yield d, zlib.crc32(str("" if d is None else d).encode()) % 10 == 0, len(tokens), sum(learned[w] > 0 for w in tokens), n, round(score, 6)


def test_class_scores(odd_docs, odd_rows):
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in classlm.score_texts(odd_docs).collect()]
    assert sorted(got, key=repr) == sorted(base_scores(odd_rows), key=repr)


def test_class_scores_of_supplied_texts(spark, sf):
    rows = queries()["op8_class_lm"](spark, sf).collect()
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    assert sorted(got) == sorted(base_scores(rows_of(sf)))
    held_out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)  # better than words alone


def test_class_chances_add_up(spark, tmp_path):
    """Over all words the model can tell apart, and one unseen by shape, the chances after any class sum to one."""
    docs = [(i, t) for i, t in enumerate(["a b c d a b", "b a c", "c d", "a a b"] * 6)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    from pyspark.sql import functions as F

    rows = spark.read.parquet(str(tmp_path / "d")).select(F.col("doc_id").alias("doc"), F.lit(False).alias("held_out"), "text")
    counted = rows.mapInArrow(classlm._send(4), classlm._SENT).groupBy("range").applyInArrow(classlm._count(84), classlm._BACK)
    model = classlm.fit_classes(rows, counted, 24, 84)
    assert np.allclose((10**model.follows).sum(1), 1)
    assert len(model.frequent) == 4 and model.vocabulary == 4 and model.tokens == 108
    words = T.words_of([b"a b c d"])
    counts = {b"a": 30, b"b": 24, b"c": 18, b"d": 12}
    ids = classlm._ids(words.hashes(), classlm.shapes(words), model.frequent, model.order)
    own = model.own[ids]
    assert model.total[own].sum() >= 84
    for c in set(own.tolist()):
        held = [counts[words.word(i)] for i in range(4) if own[i] == c]
        assert (10 ** model.emission(np.array([*held, 0.0]), np.full(len(held) + 1, c))).sum() == pytest.approx(1)


def test_exchange_finds_word_classes():
    """Two kinds of words that take turns end in two classes."""
    rng = np.random.default_rng(0)
    pairs = np.zeros((20, 20))
    at = 0
    for _ in range(5000):
        to = rng.integers(0, 10) + (0 if at >= 10 else 10)
        pairs[at, to] += 1
        at = to
    own = classlm.exchange(pairs, classes=2, fixed=0)
    assert len(set(own[:10])) == 1 and len(set(own[10:])) == 1 and own[0] != own[19]


def test_words_seen_often_go_where_the_likelihood_gains_most():
    """Against the terms of the objective that a word changes, for every class: its neighbours' cells, less the class's margins."""
    rng = np.random.default_rng(9)
    size, fixed = classlm.SHAPES + 1 + 6, classlm.SHAPES + 1
    grid = rng.integers(0, 400, (size, size)).astype(float)
    left, right = (rng.integers(0, 30, (40, size)) * (rng.random((40, size)) < 0.3) for _ in range(2))
    right[:, 0] += np.maximum(0, left.sum(1) - right.sum(1))  # as many after a word as before it
    left[:, 0] += np.maximum(0, right.sum(1) - left.sum(1))
    got = classlm.best_classes(left, right, grid)
    for i in range(40):
        worth = []
        for b in range(fixed, size):
            x = lambda v: v * np.log(np.maximum(v, 1))
            rows, columns, n = grid.sum(1), grid.sum(0), right[i].sum()
            apart = x(grid[b] + right[i]).sum() - x(grid[b]).sum() + x(grid[:, b] + left[i]).sum() - x(grid[:, b]).sum()
            worth.append(apart - x(rows[b] + n) + x(rows[b]) - x(columns[b] + n) + x(columns[b]))
        assert got[i] == fixed + int(np.argmax(worth))


def test_words_of_two_kinds_get_classes_of_their_own(spark, tmp_path):
    """Common words a and b are followed by words of two kinds, each too rare to be frequent; all of a kind end in one class."""
    rng = random.Random(4)
    kinds = {"a": [f"noun{i:03d}" for i in range(1000)], "b": [f"verb{i:03d}" for i in range(1000)]}
    docs = []
    for i in range(1500):
        pairs = [(c, rng.choice(kinds[c])) for c in rng.choices("ab", k=40)]
        docs.append((i, " ".join(f"{c} {w}" for c, w in pairs)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    stored, plain = [], classlm.freeze
    classlm.freeze = lambda df: stored.append(plain(df)) or stored[-1]
    try:
        rows = classlm.score_texts(spark.read.parquet(str(tmp_path / "d"))).collect()
    finally:
        classlm.freeze = plain
    held_out = [r for r in rows if r["held_out"]]
    # Classes tell which kind comes next: half a bit a word and more over words alone.
    assert len(held_out) > 50
    gain = sum(r["score"] - r["base_score"] for r in held_out) / sum(r["n_tokens"] for r in held_out)
    assert gain > 0.1 * np.log10(2)
    given = next(df for df in stored if set(df.columns) == {"block", "kind", "range", "a", "b"})
    shares = [T.unpack(r["b"], float) for r in given.filter("kind = 3").collect()]
    assert sum(x[: classlm.SHAPES + 1].sum() for x in shares) == 0  # none is left to its shape


def test_share_of_words_in_learned_classes(spark, sf):
    """Every word seen ten times in training, and most running words."""
    stored, plain = [], classlm.freeze
    classlm.freeze = lambda df: stored.append(plain(df)) or stored[-1]
    try:
        classlm.score_texts(spark.read.parquet(f"{sf}/documents.parquet")).count()
    finally:
        classlm.freeze = plain
    counts = Counter()
    for d, t in rows_of(sf):
        if zlib.crc32(str(d).encode()) % 10:
            counts.update(brute.words(brute.lowered(t)))
    total = sum(counts.values())
    often = {w: n for w, n in counts.items() if n >= classlm.MIN_SEEN and n * classlm.FREQUENT < total}
    given = next(df for df in stored if set(df.columns) == {"block", "kind", "range", "a", "b"})
    sums = [(T.unpack(r["a"], float).sum(), T.unpack(r["b"], float).sum()) for r in given.filter("kind = 3").collect()]
    assert (sum(n for n, _ in sums), sum(k for _, k in sums)) == (sum(often.values()), len(often))


@pytest.mark.parametrize("run", [repeats.drop_repeats, quality.judge_quality, jaccard.jaccard_components, lines.dedup_lines, classlm.score_texts])
def test_no_rows(no_docs, run):
    assert run(no_docs).count() == 0


def test_substring_dedup_takes_its_input_in_bounded_batches(spark):
    named = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(named)
    spark.conf.set(named, str(1 << 28))
    try:
        docs = freeze(spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string"))
        assert {r["doc_id"]: r["n_words"] for r in repeats.drop_repeats(docs).collect()} == {1: 3, 2: 0}
        assert int(spark.conf.get(named).rstrip("b")) <= T.BATCH_BYTES
    finally:
        spark.conf.set(named, before)
