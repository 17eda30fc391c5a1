"""Decontamination, URL filter, rollups, secrets and mixing against plain answers."""

import hashlib
import itertools
import random
import re
import time

import brute
import numpy as np
import oracle
import pandas as pd
import pytest
from harkline.llm import components, decontaminate, mixing, rollup, secrets, urls
from harkline.llm import text as T
from pyspark.sql import functions as F
from __spark_entry__ import oracle_sql, queries

CHECK = "/root/testdata/sf0.01"

# Decontamination


def plain_scores(index, words):
    """The share of each item that a passage holds, item by item."""
    own = set(words)
    scores = {}
    for w, p in index.postings.items():
        if w in own:
            for i, x in zip(p.items, p.weights):
                scores[i] = scores.get(i, 0) + x
    return scores


def made_items(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{int(rng.random() ** 3 * 300)}" for _ in range(rng.randint(8, 40))).encode(), b"yes w1 w2") for i in range(n)]


def test_wand_finds_all_above_the_threshold():
    index = decontaminate.Index(made_items(300))
    rng = random.Random(2)
    for least in (0.2, 0.5, 0.8):
        for _ in range(60):
            item = index.parts and made_items(300)[rng.randrange(300)][1].decode().split()
            words = [w for w in item if rng.random() < 0.7] + [f"w{int(rng.random() ** 3 * 300)}" for _ in range(40)]
            query = set(T.words_of([" ".join(words).encode()]).hashes().tolist())
            want = {i: s for i, s in plain_scores(index, query).items() if s >= least}
            got = dict(index.above(query, least))
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_passages_left_out_hold_nothing():
    items = made_items(200)
    index = decontaminate.Index(items)
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        words = [f"w{int(rng.random() ** 3 * 300)}" for _ in range(rng.randint(0, 200))]
        if rng.random() < 0.5:
            q = items[rng.randrange(200)]
            at = rng.randint(0, len(words))
            words[at:at] = (q[1] + b" " + q[2]).decode().split()
        texts.append(" ".join(words).encode())
    words = T.words_of(texts, lower=True).stripped()
    found = decontaminate._hits(index, words, words.hashes())
    want = set()
    for d, text in enumerate(texts):
        hashes = T.words_of([text], lower=True).hashes()
        half = index.half
        for k in range(max(1, -(-len(hashes) // half) - 1)):
            own = hashes[k * half : (k + 2) * half]
            held = decontaminate.pairs(own) | set(own.tolist())
            for i, s in plain_scores(index, own.tolist()).items():
                asked, answered = (decontaminate._share(p, held) for p in index.parts[i])
                if s >= 0.5 and asked >= 0.5 and answered >= 0.5:
                    want.add((d, i))
    assert set(found) == want and len(want) > 60


def test_decontamination_finds_planted_items(spark):
    docs, items = pd.read_parquet(f"{CHECK}/documents.parquet"), pd.read_parquet(f"{CHECK}/benchmark.parquet")
    plain = lambda t: f" {' '.join(brute.words(brute.lowered(t)))} "
    texts = {i: plain(t) for i, t in zip(items.item_id, items.text)}
    want = {(d, i) for d, t in zip(docs.doc_id, map(plain, docs.text)) for i, x in texts.items() if x in t and len(x.split()) >= 8}
    got = {(r["doc_id"], r["item_id"]) for r in queries()["op1_decontamination"](spark, CHECK).collect()}
    assert want <= got and len(want) > 5
    assert len(got - want) <= 0.1 * len(want) + 2


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    rows = [(1, texts[140], "w0"), (1, texts[140], None), (2, None, None), (3, "too short", "it is"), (None, texts[131], None), (4, texts[30], "nowhere at all")]
    items = spark.createDataFrame(rows, "item_id long, question string, answer string")
    for limit in (decontaminate.INDEX_BYTES, 10):  # in one index, and in one for each item
        hits = decontaminate.find_items(odd_docs, items, index_bytes=limit)
        assert {(r["doc_id"], r["item_id"]) for r in hits.collect()} == {(d, 1) for d in (100, 101, 102, 103, 104, 105, 132, 140)} | {(131, None)}
        left = decontaminate.drop_contaminated(odd_docs, items, index_bytes=limit)
        assert left.schema == odd_docs.schema and left.count() == odd_docs.count() - 10
    assert decontaminate.find_items(no_docs, items).count() == 0
    assert decontaminate.find_items(odd_docs, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_what_is_found_does_not_depend_on_parts_or_other_items(spark):
    """Short items beside one of four thousand words, in one part and in many; texts of common words hold none of them."""
    rng = random.Random(11)
    common = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(common, k=12)), "") for i in range(50)]
    texts = [" ".join(rng.choices(common, k=900)) for _ in range(6)] + [f"{texts_} end" for texts_ in (items[3][1], items[7][1])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    long = (99, " ".join(rng.choices(common, k=4000)), "")
    schema = "item_id long, question string, answer string"
    hits = lambda rows, size: {
        (r["doc_id"], r["item_id"], round(r["score"], 9)) for r in decontaminate.find_items(docs, spark.createDataFrame(rows, schema), index_bytes=size).collect() if r["item_id"] != 99
    }
    whole = hits([*items, long], decontaminate.INDEX_BYTES)
    assert {(d, i) for d, i, _ in whole} >= {(6, 3), (7, 7)} and not [d for d, _, _ in whole if d < 6]
    assert hits([long, *items[::-1]], 200) == whole == hits([*items, long], 1)
    assert {x[:2] for x in hits(items, decontaminate.INDEX_BYTES)} == {x[:2] for x in whole}


def test_short_items_are_found_as_they_are(spark):
    rows = [(1, "seven times", "eight"), (2, "Blue?", None), (3, "times eight", ""), (4, "", " "), (1, "blue", "")]
    items = spark.createDataFrame(rows, "item_id long, question string, answer string")
    texts = ["It is SEVEN times, eight. seven times eight", "eight seven times", "times\neight blue", None, "", "a times", "eight"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["start"], r["words"]) for r in decontaminate.find_items(docs, items).collect())
    assert got == [(0, 1, 2, 3), (0, 3, 3, 2), (2, 1, 2, 1), (2, 2, 2, 1), (2, 3, 0, 2)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()) == [1, 3, 4, 5, 6]


def test_question_and_answer(spark):
    items = spark.createDataFrame([(1, "Who? Me. You."), (2, "No end"), (3, None), (4, "")], "item_id long, text string")
    got = {r["item_id"]: (r["question"], r["answer"]) for r in decontaminate.question_and_answer(items).collect()}
    assert got == {1: ("Who? Me. ", "You."), 2: ("No end", ""), 3: (None, None), 4: ("", "")}


def test_edited_and_cut_copies_of_items_are_found(spark):
    """A guessed answer of few words need not occur; an answer of its own must. Punctuation around words is not compared."""
    asked = "If ann has nine red apples, and bob takes four of them away, how many apples are left with ann now?"
    rows = [(1, f"{asked} It is five."), (2, "Name the (longest) river that flows through the whole of the old town! Rhine.")]
    guessed = decontaminate.question_and_answer(spark.createDataFrame(rows, "item_id long, text string"))
    texts = [f"x y z {asked} It was&&& six", f"x y z {asked}", "a b \"name the longest\" river, that flows through the whole of the old town", "nothing of it " * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(docs, guessed).collect()} == {(0, 1), (1, 1), (2, 2)}
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, guessed).collect()] == [3]
    real = guessed.drop("guessed")
    assert decontaminate.find_items(docs, real).count() == 0
    words = T.words_of([b"(ab). && c-d e\xc3\xa9, ..x"]).stripped()
    assert [words.word(i) for i in range(5)] == [b"ab", b"&&", b"c-d", b"e\xc3\xa9", b"x"]


# URL filter

URLS = [
    "http://a.org/x", "https://EXAMPLE.org/es/1", "https://www.example.org/en/1234", "https://badexample.org/es/", "http://b.com/fr/x?q=/de/", "http://b.com/de/",
    "http://b.com/de", "http://com/fr/", "ftp://b.net", "no scheme", "", None, "://", "http://?x", "http://a.org#://b.com/fr/", "a://b://c.com/de/x", "http://é.org/ü\n/de",
    "http://example.org/en/2", "http://x.comb/fr/", "http://B.COM/FR/", "http://b.com/fr/", "http://b.com/fr/",
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    host, path = re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path
    fits = [
        (r, v) for r, v in urls.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://q.org/", "x", "y")], "page_id long, url string, host string, verdict string")
    rows = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain_url(url)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == verdict if verdict else rows[i]["verdict"] in ("allow", "block")
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_url_rules_of_supplied_pages(spark, sf):
    pages = pd.read_parquet(f"{sf}/pages.parquet")
    rows = {r["page_id"]: r for r in queries()["op4_url_filter"](spark, sf).collect()}
    assert len(rows) == len(pages)
    for i, url in zip(pages.page_id, pages.url):
        host, path, rule, verdict = plain_url(url)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule) and (not verdict or rows[i]["verdict"] == verdict)


def test_char_model_is_a_distribution():
    model = urls.CharModel.fit(["abab", "abba", "b"], order=2)
    chance = lambda context, c: _chance(model, context, c)
    for context in ("ab", "ba", "\x02\x02", "zz"):
        seen = sum(chance(context, c) for c in "ab\x03")
        unseen = chance(context, "z")
        assert seen + (urls.ALPHABET - 3) * unseen == pytest.approx(1)


def _chance(model, context, c):
    p = 1 / urls.ALPHABET
    for k in range(model.order + 1):
        after = model.counts.get(context[len(context) - k :])
        if after is None:
            break
        p = (after.get(c, 0) + len(after) * p) / (sum(after.values()) + len(after))
    return p


def test_url_models_tell_kinds_apart(spark):
    rng = random.Random(5)
    good = [f"news/{rng.choice(['story', 'report'])}/{rng.randrange(1000)}" for _ in range(400)]
    bad = [f"{rng.choice(['win', 'cash'])}-{rng.choice(['now', 'free'])}/{rng.randrange(1000)}" for _ in range(400)]
    rows = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in bad] + [(None, True), ("x", None)], "text string, accepted boolean")
    model = urls.fit_filter(rows)
    assert all(model.margin(f"news/report/{i}") >= model.threshold for i in range(1000, 1050))
    assert all(model.margin(f"free-cash-now/{i}") < model.threshold for i in range(1000, 1050))
    assert urls.fit_filter(rows.filter("accepted")).threshold == 0


def test_url_models_see_whole_urls(spark):
    """Queries, digits and first host labels tell, and patterns count as often as they occur; what a rule fits does not tell."""
    rules = (("org/ok/", "allow"), ("org/no/", "block"))
    rows = [f"http://news{i}.org/ok/a?id=story{i}" for i in range(200)] + [f"http://free-bets{i}.org/no/a?win=cash{i}" for i in range(200)]
    rows += [f"http://{h}{i}.net/q?{q}{i}" for i in range(300, 320) for h, q in (("news", "id=story"), ("free-bets", "win=cash"))]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {rows[r["page_id"]]: r for r in urls.judge_urls(pages, rules).collect()}
    for i in range(300, 320):
        assert got[f"http://news{i}.net/q?id=story{i}"]["verdict"] == "allow" and got[f"http://free-bets{i}.net/q?win=cash{i}"]["verdict"] == "block"
    made = spark.createDataFrame([("HTTP://A.B.org/ok/X?y#z",), ("http://A.net/X?y#z",), ("odd X",), (None,)], "url string")
    host, path = urls.split_url(F.col("url"))
    texts = made.select(urls.model_text(F.col("url"), host, urls.rule_of(host, path, rules)["rule"]).alias("t")).collect()
    assert [r["t"] for r in texts] == [f"http://a.b.{urls.MASK * 2}X?y#z", "http://a.net/X?y#z", "odd X", ""]
    often = spark.createDataFrame([(f"u{i}", "aa" if i < 90 else "bb", True) for i in range(100)], "url string, text string, accepted boolean")
    model = urls.fit_filter(often)
    assert model.accepted.log_probability("aa") > model.accepted.log_probability("bb") + 1


# Token rollups


def test_rollup_against_sql(spark, sf):
    assert oracle.spark_rows(queries()["op6_token_counts"](spark, sf)) == oracle.sql_rows(oracle.connect(sf), oracle_sql()["op6_token_counts"])


def test_rollup_batches(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, sign int, tokens long, n_tokens string"
    rows = rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rows.totals().count() == 0
    first = spark.createDataFrame([("a", "en", "t", 1, 5, ""), ("a", "en", "t", 1, 5, ""), (None, None, "t", 1, 3, ""), ("b", "en", "t", 1, None, ""), ("b", "en", "t", None, 9, "")], schema)
    assert rows.commit("1/one", first) and not rows.commit("1/one", first)
    assert rows.commit("empty", first.limit(0))
    (tmp_path / "rollup" / "writing-broken").mkdir()  # what a lost writer leaves
    got = {tuple(r) for r in rows.totals().collect()}
    assert got == {("a", "en", "t", 2, 10), (None, None, "t", 1, 3), ("b", "en", "t", 1, 0)}
    revised = spark.createDataFrame([("a", "en", "t", -1, 5, ""), ("a", "en", "t", 1, 8, ""), (None, None, "t", -1, 3, "")], schema)
    assert rows.commit("2", revised)
    assert {tuple(r) for r in rollup.TokenRollup(spark, str(tmp_path / "rollup")).totals().collect()} == {("a", "en", "t", 2, 13), ("b", "en", "t", 1, 0)}


def test_counted(odd_docs):
    got = {(r["doc_id"], r["tokenizer"]): r["tokens"] for r in rollup.counted(odd_docs).filter("doc_id in (120, 121, 125, 127)").collect()}
    text = "Éa \x1c ü\x0bß � 漢字 " * 30
    assert got == {(120, "words-1"): 0, (120, "bytes-1"): 0, (121, "words-1"): 0, (121, "bytes-1"): 0, (125, "words-1"): 3, (125, "bytes-1"): 12,
                   (127, "words-1"): len(brute.words(text)), (127, "bytes-1"): len(text.encode())}


# Secret scans

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    names = ["assign", "access", "hex"]
    listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return tuple(sum(s[1] == k for s in spans) for k in range(3)), listed


SECRETS = [
    'x token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" y', "password: token:abcdefgh1", "PASSWORD=abcdefg api_key:'12345678' ApiKey = ZZZZZZZZZ=", "AKIAAKIA12345678 AKIA123",
    "AKIA" + "Z" * 30 + " AKIAMD62HKU6VBLCCCC", "é漢😀 secret=aaaaaaaa😀 " + "0123456789abcdef" * 2, "deadbeef" * 4 + "G" + "deadbeef" * 5, "token=secret=abcdefghij", None, "", "token", "=" * 50,
    "paſſword=abcdefghij passwd = 'x'", "ghp_16C7e42F292c6912E7710c838347Ae178B4a", "id 550e8400-e29b-41d4-a716-446655440000 end", "token='a' token=bbbbbbbb\ntoken\x20\x20:\x20zzzzzzzzz",
]


def test_secrets(spark):
    rows = [(i, t, f"o{i % 5}", "en", "x") for i, t in enumerate(SECRETS)] + [(None, SECRETS[0], None, None, "x"), (0, SECRETS[0], "o0", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, spans string")
    got = secrets.scan_secrets(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        counts, listed = plain_secrets(SECRETS[r["doc_id"] or 0])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == counts and r["base"] == listed
        assert set(filter(None, r["base"].split(","))) <= set(r["spans"].split(","))
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert spans[13] == "owned:0:40" and spans[14] == "owned:3:39"
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


def test_secrets_of_supplied_texts(spark):
    frame = pd.read_parquet(f"{CHECK}/documents.parquet")
    want = {d: plain_secrets(t) for d, t in zip(frame.doc_id, frame.text)}
    for r in queries()["op9_secret_scan"](spark, CHECK).collect():
        counts, listed = want[r["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == counts
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_a_text_of_a_hundred_thousand_secrets(spark):
    """The work follows the matches of one text, not their square."""
    n = 100_000
    docs = spark.createDataFrame([(1, " ".join(f"password=abcdef{i:08d}" for i in range(n)), "a", "en")], "doc_id long, text string, source string, lang string")
    start = time.monotonic()
    row = secrets.scan_secrets(docs).head()
    assert time.monotonic() - start < 120
    assert (row["n_assign"], row["n_live"], row["n_copied"]) == (n, n, 0)
    assert row["base"].split(",")[-1] == f"assign:{24 * (n - 1)}:{24 * n - 1}"


def test_secrets_by_owner(spark):
    own, common = "Zx9_" + "a1B2c3D4e5F6" * 2, "Example_1234567890_abcdef"
    rows = [(i, f"see {common} ok", f"o{i % 4}", "en") for i in range(12)] + [(20, f"{own} and {common}", "o1", "en"), (21, f"my password={own}", "o1", "de")]
    got = {r["doc_id"]: r for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert got[0]["spans"] == "" and got[0]["n_copied"] == 1 and got[0]["max_owners"] == 4
    assert got[20]["spans"] == "owned:0:28" and (got[20]["n_live"], got[20]["n_copied"]) == (1, 1)
    assert got[21]["spans"].startswith("assign:3:") and got[21]["n_live"] == 1 and got[21]["max_repositories"] == 2


def test_secret_scan_is_native(spark, sf):
    plan = queries()["op9_secret_scan"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Mixing sources


def plain_targets(sizes, weights, total, most):
    targets, held = {}, dict(enumerate(sizes))
    while held:
        left = total - sum(targets.values())
        share = {i: left * weights[i] / sum(weights[j] for j in held) for i in held}
        above = [i for i in held if share[i] > most * held[i]]
        if not above:
            return [{**targets, **share}[i] for i in range(len(sizes))]
        for i in above:
            targets[i] = most * held.pop(i)
    return [targets[i] for i in range(len(sizes))]


def test_targets():
    for sizes in ([10, 10, 10], [1, 100, 1000, 5], [0, 7, 3], [5], [1, 1, 1, 500]):
        weights = [5, 2, 1, 5][: len(sizes)]
        got = mixing.capped_targets(sizes, weights, sum(sizes), 3)
        assert got == pytest.approx(plain_targets(sizes, weights, sum(sizes), 3)) and sum(got) == pytest.approx(sum(sizes))


def test_flow_costs_least():
    rng = random.Random(4)
    for _ in range(30):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 3) for _ in range(n)]
        members = [sorted(rng.sample(range(m), rng.randint(1, m))) for _ in range(n)]
        quotas = [rng.randint(0, 5) for _ in range(m)]
        flow = mixing.least_cost_flow(supply, members, quotas)
        cost = lambda p, x: sum(min(max(x - k * supply[p], 0), supply[p]) * c for k, c in enumerate(mixing.REPEAT_COSTS))  # noqa: E731, B023
        got = (-sum(sum(f.values()) for f in flow), sum(cost(p, sum(f.values())) for p, f in enumerate(flow)))
        assert all(sum(f.get(q, 0) for f in flow) <= quotas[q] for q in range(m))
        assert all(sum(f.values()) <= 3 * supply[p] for p, f in enumerate(flow))
        edges = [(p, q) for p in range(n) for q in members[p]]
        best = (0, 0)
        for amounts in itertools.product(*[range(min(quotas[q], 3 * supply[p], 5) + 1) for p, q in edges]) if len(edges) <= 5 else []:
            out, into = [0] * n, [0] * m
            for (p, q), x in zip(edges, amounts):
                out[p] += x
                into[q] += x
            if all(o <= 3 * s for o, s in zip(out, supply)) and all(i <= t for i, t in zip(into, quotas)):
                best = min(best, (-sum(out), sum(cost(p, x) for p, x in enumerate(out))))
        assert len(edges) > 5 or got == best


def test_mix_of_odd_rows(odd_docs, odd_rows, no_docs):
    rows = mixing.mix_sources(odd_docs).toPandas()
    assert len(rows) == len(odd_rows)
    assert sorted(rows.mix_size) == sorted(len(brute.words(t)) for _, t in odd_rows)
    names = rows.mix_sources.map(lambda s: s[0])
    order = sorted(set(names), key=lambda s: (s is None, s or ""))
    sizes = [int(rows.mix_size[names.map(lambda x, s=s: x == s or (x is None and s is None))].sum()) for s in order]
    targets = plain_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(order))], sum(sizes), 3)
    for s, size, target in zip(order, sizes, targets):
        own = rows[names.map(lambda x, s=s: x == s or (x is None and s is None))]
        assert (own.mix_source_size == size).all() and np.allclose(own.mix_target, target)
        assert abs(own.mix_taken.sum() - target) <= own.mix_size.max()
    assert (rows.mix_taken == rows.mix_copies * rows.mix_size).all() and rows.mix_copies.max() <= 3
    again = mixing.mix_sources(odd_docs.repartition(7)).toPandas()
    key = lambda f: sorted(zip(f.doc_id.fillna(-1), f.mix_size, f.mix_taken))
    assert key(rows) == key(again)
    assert mixing.mix_sources(no_docs).count() == 0


def test_mix_of_supplied_texts(spark):
    rows = queries()["op10_source_mix"](spark, CHECK).toPandas()
    docs = pd.read_parquet(f"{CHECK}/documents.parquet")
    assert sorted(zip(rows.doc_id, rows["size"])) == sorted((d, len(brute.words(t))) for d, t in zip(docs.doc_id, docs.text))
    by = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max")).sort_index()
    assert np.allclose(by.target, plain_targets(by["size"].tolist(), [(5, 2, 1)[i % 3] for i in range(len(by))], by["size"].sum(), 3))
    assert ((by.taken - by.target).abs() <= by.most).all() and (rows.taken <= 3 * rows["size"]).all()


def test_mix_of_overlapping_sources(spark):
    rows = [(i, i % 3) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, kind int")
    members = F.when(F.col("kind") == 0, F.array(F.lit("a"))).when(F.col("kind") == 1, F.array(F.lit("b"), F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b")))
    got = mixing.mix_sources(docs, {"a": 1.0, "b": 1.0}, sources=members, size=F.lit(10)).toPandas()
    assert got.mix_taken.sum() == 3000 and (got.mix_copies == 1).all()  # all used once before any is repeated
    got = mixing.mix_sources(docs, {"a": 1.0}, sources=members, size=F.lit(10)).toPandas()
    taken = got.groupby(got.mix_sources.map(tuple)).mix_taken.sum()
    assert taken[("b",)] == 0 and taken.sum() == 3000 and got.mix_copies.max() == 2  # both used once before either is used twice
    assert min(taken[("a",)], taken[("a", "b")]) >= 1000


# Components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(50)] + [(i, i + 1) for i in range(2_000_000, 2_000_040)]
    links += [(3_000_000, 3_000_000 + rng.randrange(1, 200)) for _ in range(100)] + [(5, 5)]
    nodes = {x for a, b in links for x in (a, b) if a != b}
    got = {r["node"]: r["root"] for r in components.smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.components([x for x in links if x[0] != x[1]], nodes)
    assert components.smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0
