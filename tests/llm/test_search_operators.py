"""Fingerprints, lexical search and hard negatives against plain answers."""

import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import Row, functions as F, types as T

from harkline.llm import fingerprints, lexical, negatives, queries

# Fingerprints


def weights(text, piece=fingerprints.PIECE):
    return Counter(re.findall(rf"[^\x20\x09-\x0D]{{1,{piece}}}", brute.lowered(text)))


def generalised_jaccard(a, b):
    x, y = weights(a), weights(b)
    most = sum((x | y).values())
    return sum((x & y).values()) / most if most else 1.0


def edited_texts(rows):
    """(id, text, edited text, next text), in order of id, null ids last."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        q = len(t) // 4
        out.append((d, t, t[: len(t) - q] + after[:q], after))
    return out


def unique_ids(rows):
    count = Counter(d for d, _ in rows)
    return [(d, t) for d, t in rows if count[d] == 1 and d is not None]


@pytest.fixture(scope="module")
def edits(spark, odd_docs, odd_rows):
    ids = [d for d, _ in unique_ids(odd_rows)]
    docs = odd_docs.filter(F.col("doc_id").isin(ids))
    path = f"{spark.conf.get('spark.checkpoint.dir')}/unique"
    docs.write.mode("overwrite").parquet(path)
    return fingerprints.fingerprint_edits(spark.read.parquet(path)).collect()


def test_edited_texts_are_those_asked_for(edits, odd_rows):
    want = {d: (len(t), brute.sha(e)) for d, t, e, _ in edited_texts(unique_ids(odd_rows))}
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in edits} == want


def test_likeness_is_the_generalised_jaccard_similarity(edits, odd_rows):
    got = {r["doc_id"]: r for r in edits}
    off = []
    for d, t, e, after in edited_texts(unique_ids(odd_rows)):
        for name, want in (("near_edited", generalised_jaccard(t, e)), ("near_next", generalised_jaccard(t, after))):
            off.append(got[d][name] - want)
            # Four and a half standard errors of 64 samples.
            assert abs(off[-1]) <= 4.5 * math.sqrt(max(want * (1 - want), 0.003) / fingerprints.SAMPLES)
    assert abs(sum(off) / len(off)) < 0.02


def test_equal_texts_have_equal_fingerprints(spark, odd_docs):
    rows = fingerprints.fingerprint_edits(odd_docs.withColumn("marks", F.lit("a clash"))).collect()
    assert len(rows) == odd_docs.count()
    plain = {r["doc_id"]: r["marks"] for r in fingerprints.fingerprint_texts(odd_docs.filter("doc_id IN (3, 5, 70, 71, 120, 121, 122)")).collect()}
    assert plain[3] == plain[5] == plain[70] == plain[71] and len(plain[3]) == fingerprints.SAMPLES and min(plain[3]) >= 0
    assert plain[120] == plain[121] == plain[122] == []
    edited = {r["doc_id"]: r for r in rows if r["doc_id"] in plain}
    assert all(edited[d]["marks"] == m for d, m in plain.items())
    assert edited[121]["near_edited"] == 1.0


def test_weights_count(spark):
    docs = spark.createDataFrame([(1, "a " * 9 + "b"), (2, "a " + "b " * 9), (3, "a b")], "doc_id long, text string")
    marks = {r["doc_id"]: r["marks"] for r in fingerprints.fingerprint_texts(docs, k=512).collect()}
    share = lambda a, b: sum(x == y for x, y in zip(marks[a], marks[b])) / 512
    assert share(1, 2) == pytest.approx(2 / 18, abs=0.06) and share(1, 3) == pytest.approx(2 / 10, abs=0.08)


def test_bound_leaves_no_sample_out(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"{i}x{j % 40}" for j in range(300))) for i in range(20)], "doc_id long, text string")
    bounded = fingerprints.fingerprint_texts(docs).sort("doc_id").collect()
    monkeypatch.setattr(fingerprints, "REACH", 1e9)
    assert fingerprints.fingerprint_texts(docs).sort("doc_id").collect() == bounded


def test_samples_of_one_weight_do_not_depend_on_another(spark, monkeypatch):
    """Even where the bound leaves samples without a candidate, which is common with so low a reach."""
    monkeypatch.setattr(fingerprints, "REACH", 0.5)
    rows = [(k, j * 7919, 1, 3 if k % 2 else 1, 30, 90 if k % 2 else 3000) for k in range(80) for j in range(30)]
    weighted = spark.createDataFrame(rows, "key int, term long, a long, b long, na long, nb long")
    found = fingerprints.samples(weighted, "key", {"x": ("a", "na"), "y": ("b", "nb")}).filter("x is not null").collect()
    by_key = {}
    for r in found:
        by_key.setdefault(r["key"], set()).add((r["sample"], r["x"]))
    assert len(by_key) == 80 and len({frozenset(v) for v in by_key.values()}) == 1
    assert len(by_key[0]) < fingerprints.SAMPLES


def test_no_fingerprints_of_nothing(no_docs):
    assert fingerprints.fingerprint_edits(no_docs).count() == 0 and fingerprints.fingerprint_texts(no_docs).count() == 0


def test_one_document_is_followed_by_itself(spark):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/one"
    spark.createDataFrame([(7, "abcd efgh")], "doc_id long, text string").write.mode("overwrite").parquet(path)
    row = fingerprints.fingerprint_edits(spark.read.parquet(path)).head()
    assert row["edited_sha256"] == brute.sha("abcd efab") and row["near_next"] == 1.0


# Lexical search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lowered(text))


def ranked(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = set()
    for i, asked in wanted.items():
        scored = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out |= {(i, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)}
    return out


ITEMS = [(1, "w1 w2, w3 w10 w5f"), (2, "same"), (3, None), (4, "nowhere"), (5, "É ß 漢字 a\x1cb"), (5, "w7"), (None, "W11-w12 la"), (6, " ".join(f"w{i:x}" for i in range(900)))]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("rank", F.lit("a clash"))


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_ranks_as_one_document_after_the_other(odd_docs, odd_rows, items):
    assert got(lexical.rank_documents(odd_docs, items)) == sorted(ranked(odd_rows, ITEMS), key=repr)


@pytest.mark.parametrize(("rows", "leaf", "item_bytes"), [(16, 2, 4_000_000), (64, 1, 1), (40, 8, 30)])
def test_trees_leaves_and_blocks_change_nothing(odd_docs, odd_rows, items, monkeypatch, rows, leaf, item_bytes):
    monkeypatch.setattr(lexical, "TREE_ROWS", rows)
    monkeypatch.setattr(lexical, "LEAF", leaf)
    assert got(lexical.rank_documents(odd_docs, items, item_bytes=item_bytes)) == sorted(ranked(odd_rows, ITEMS), key=repr)


def test_branches_that_cannot_win_are_left_out():
    rng = np.random.default_rng(5)
    n, size = 4000, 300
    lists = [np.unique((size * rng.random(30) ** 2).astype(int)) for _ in range(n)]
    sizes = np.array([len(x) for x in lists])
    tree = lexical.Tree(list(range(n)), rng.integers(20, 300, n), np.concatenate(lists), rng.integers(1, 6, sizes.sum()), sizes, size)
    read = []

    class Counted(list):
        def __getitem__(self, i):
            read.append(i)
            return super().__getitem__(i)

    tree.spans = Counted(tree.spans)
    leaves = sum(c is None for c in tree.children)
    item, weights_, place = np.array([1, 250, 280]), np.array([100, 5000, 6000]), np.full(size, -1)
    place[item] = np.arange(3)
    best = tree.search(item, weights_, place, [], 10)
    assert len(best) == 10 and leaves > 60 and len(read) < leaves


def test_nothing_to_rank(no_docs, odd_docs, items):
    assert lexical.rank_documents(no_docs, items).count() == 0
    assert lexical.rank_documents(odd_docs, items.limit(0)).count() == 0
    assert lexical.rank_documents(odd_docs, items.filter("text IS NULL")).count() == 0


# Hard negatives


def mined(rows, anchors, k=5):
    rows = list({(i, lab, tuple(v)) for i, lab, v in rows})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in rows:
        if not anchors(a[0]):
            continue
        others = sorted(((-dot(a[2], b[2]), b[0], b[1]) for b in rows if b != a))
        for s, p, _ in [o for o in others if o[2] == a[1]][:k]:
            fits = [o for o in others if o[2] != a[1] and 80 * -s <= 100 * -o[0] <= 100 * -s][:k]
            out += [(a[0], p, r, o[1], -s, -o[0]) for r, o in enumerate(fits, 1)]
    return sorted(out)


VECTORS = "vec_id long, label int, vector array<int>, key string, block string"


def vectors(rng, n, width=6):
    rows = [(i, int(rng.integers(0, 4)), rng.integers(-200, 200, width).tolist()) for i in range(n)]
    common = rng.integers(0, 200, width).tolist()
    return rows + [(n + i, i % 3, common) for i in range(60)]


@pytest.mark.parametrize(("block", "anchors", "page"), [(2048, 256, 256), (16, 4, 3), (7, 3, 1)])
def test_negatives_as_plain(spark, monkeypatch, block, anchors, page):
    for name, value in (("BLOCK", block), ("ANCHORS", anchors), ("PAGE", page)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(np.random.default_rng(3), 400)
    rows += rows[:20]  # repeats count once
    rows += [(1001, 1, []), (1010, 2, [5]), (1003, 1, [negatives.LIMIT] * 6), (1004, 2, [-negatives.LIMIT] * 6), (None, 1, [1]), (1005, None, [1] * 6), (1006, 1, None)]
    df = spark.createDataFrame([(*r, "k", "b") for r in rows], VECTORS).repartition(3)
    found = negatives.mine_hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    plain = [r for r in rows if None not in r]
    assert sorted(map(tuple, found)) == mined(plain, lambda i: i % 10 == 0)


def test_zone_maps_leave_blocks_out(spark, monkeypatch):
    """Rows far apart: an anchor reads its own neighbourhood only."""
    monkeypatch.setattr(negatives, "BLOCK", 8)
    stored, plain = [], negatives.freeze
    monkeypatch.setattr(negatives, "freeze", lambda df: stored.append(plain(df)) or stored[-1])
    rng, rows = np.random.default_rng(1), []
    for i in range(320):
        v = rng.integers(-3, 4, 8)
        v[i % 8] += 900 if i % 16 < 8 else -900
        rows.append((i, i // 16 % 2, v.tolist(), "k", "b"))
    found = negatives.mine_hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0)
    assert sorted(map(tuple, found.collect())) == mined([r[:3] for r in rows], lambda i: i == 0) != []
    pairs = [df.count() for df in stored if "wanted" in df.columns]
    blocks = next(df.count() for df in stored if "counts" in df.columns)
    assert len(pairs) == 2 and blocks >= 40 and max(pairs) < blocks / 4


def test_hilbert_neighbours_differ_by_one_step():
    for width, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width, indexing="ij"), -1).reshape(-1, width)
        keys = [k.tobytes() for k in negatives.hilbert_keys(grid, bits)]
        assert len(set(keys)) == len(grid)
        path = grid[np.array(sorted(range(len(grid)), key=keys.__getitem__))]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, x = rng.integers(-50, 50, (20, 5)), rng.integers(-50, 50, (30, 5))
    below, above = negatives.bounds(a, x.min(0)[None], x.max(0)[None])
    s = a @ x.T
    assert (below[:, 0] <= s.min(1)).all() and (s.max(1) <= above[:, 0]).all()


def test_components_are_floored(spark):
    schema = T.StructType([T.StructField("embedding", T.ArrayType(T.FloatType()))])
    rows = [[0.5, -0.001], [float("nan")], [None, 1.0], None, [], [float("-inf")], [3e38, -3e38]]
    df = spark.createDataFrame([Row(embedding=r) for r in rows], schema)
    got = [r[0] for r in df.select(negatives.whole_components("embedding")).collect()]
    assert got == [[128, -1], None, None, None, [], None, [negatives.LIMIT, -negatives.LIMIT]]


def test_no_rows_no_negatives(spark):
    assert negatives.mine_hard_negatives(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_hard_negatives"])
def test_registered_with_sql(name):
    assert queries.QUERIES[name].sql
