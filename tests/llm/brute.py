"""Plain answers, one document after the other."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(docs, k=20):
    """docs: (doc_id, text). Returns {(doc_id, text): (n_words, n_removed, sha)}."""
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - k + 1):
            s = tuple(w[i : i + k])
            first[s] = min(first.get(s, (d, i)), (d, i))
    out = {}
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (d, i):
                gone.update(range(i, i + k))
        out[d, t] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def quality_counts(text):
    w, lines = words(text), (text or "").split("\n")
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen and bool(words(line))
        seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    held = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(held) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(held), failed


def components(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, n=5):
    w = words(lowered(text))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_links(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    by = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            by[g].append(i)
    shared = Counter((a, b) for held in by.values() for x, a in enumerate(held) for b in held[x + 1 :])
    return [
        (sets[a][0], sets[b][0])
        for (a, b), n in shared.items()
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n)
    ]


def line_runs(docs, least):
    """Lines with a word of each document that lie in a run of ``least`` lines with an earlier place."""
    first, held = {}, {}
    for d, t in docs:
        lines = [tuple(words(x)) for x in (t or "").split("\n") if words(x)]
        held[d, t] = lines
        for i in range(len(lines) - least + 1):
            s = tuple(lines[i : i + least])
            first[s] = min(first.get(s, (d, i)), (d, i))
    out = {}
    for (d, t), lines in held.items():
        out[d, t] = {i + k for i in range(len(lines) - least + 1) if first[tuple(lines[i : i + least])] < (d, i) for k in range(least)}
    return out
