"""URL filters: listed rules, and character models of accepted and rejected URLs where no rule fits.

Two variable-order Markov models give a URL's probability, one learned from accepted and one from
rejected URLs. A character's probability after a context mixes the counts of that context with
what the next shorter context says (Witten-Bell smoothing), down to a uniform distribution. The
difference of the two log-likelihoods, by character, is compared with a threshold that is set
where it best parts held-out labelled URLs. The models see whole URLs; only the part of a URL that a rule fits,
from which its label follows, is masked.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from harkline.llm.text import lowered

#: Longest context of the models, in characters.
ORDER = 4
#: The models and the threshold are fitted to at most so many labelled URLs of each kind, those with the
#: smallest hashes. This bounds the models, which every task holds.
MAX_TRAINING = 20_000
#: Every such labelled URL is held out to set the threshold.
HELD_OUT = 5
#: What stands for any character no model has seen: one of so many.
ALPHABET = 1024

#: What stands for the part of a host, and of a path, that a rule fits.
MASK = "\x01"

#: Fixed rules: what a host and path start with, and the verdict.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    before = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(before, r"(?s)^([^/]*)", 1)
    return lowered(host), F.substring(before, F.length(host) + F.lit(1), F.length(before))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does.

    A rule fits its host and all hosts below, where the path starts with the rule's.
    """
    found = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def model_text(url: Column, host: Column, rule: Column) -> Column:
    """The whole URL as the models see it: scheme and host lower-cased, the part that ``rule`` fits, if any, masked.

    The label follows from that part, so the models must not learn from it.
    """
    whole = F.coalesce(url, F.lit(""))
    scheme = F.regexp_extract(whole, r"(?s)^(.*?://)", 1)
    after = F.substring(whole, F.length(scheme) + F.length(host) + F.lit(1), F.length(whole))
    name = F.substring_index(rule, "/", 1)
    prefix = F.greatest(F.lit(1), F.length(rule) - F.length(name))
    masked = F.concat(
        lowered(scheme), F.substring(host, F.lit(1), F.length(host) - F.length(name)), F.lit(MASK + MASK), F.substring(after, prefix + F.lit(1), F.length(whole))
    )
    return F.when(scheme == "", whole).when(rule.isNull(), F.concat(lowered(scheme), host, after)).otherwise(masked)


@dataclass
class CharModel:
    """Counts of characters after each context of up to ``order`` characters."""

    order: int
    counts: dict[str, dict[str, int]]
    totals: dict[str, int]

    @classmethod
    def fit(cls, urls: Iterable[str], order: int = ORDER) -> CharModel:
        counts: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for url in urls:
            padded = "\x02" * order + url + "\x03"
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    counts[padded[i - k : i]][padded[i]] += 1
        plain = {c: dict(n) for c, n in counts.items()}
        return cls(order, plain, {c: sum(n.values()) for c, n in plain.items()})

    def log_probability(self, url: str) -> float:
        """Natural log of the URL's probability, its end included."""
        padded, total = "\x02" * self.order + url + "\x03", 0.0
        for i in range(self.order, len(padded)):
            p = 1 / ALPHABET
            for k in range(self.order + 1):
                after = self.counts.get(padded[i - k : i])
                if after is None:
                    break
                kinds = len(after)
                p = (after.get(padded[i], 0) + kinds * p) / (self.totals[padded[i - k : i]] + kinds)
            total += math.log(p)
        return total


@dataclass
class UrlFilter:
    accepted: CharModel
    rejected: CharModel
    threshold: float = 0.0

    def margin(self, url: str) -> float:
        """Log-likelihood by character under accepted URLs less that under rejected ones."""
        return (self.accepted.log_probability(url) - self.rejected.log_probability(url)) / (len(url) + 1)


def _best_threshold(margins: list[tuple[float, bool]]) -> float:
    """Where the mean of both kinds' right shares is largest; 0 unless both kinds occur."""
    kept, dropped = sum(ok for _, ok in margins), sum(not ok for _, ok in margins)
    if not kept or not dropped:
        return 0.0
    margins = sorted(margins)
    best, at, below_ok, below_bad = -1.0, 0.0, 0, 0
    for i, (margin, ok) in enumerate(margins):
        if i and margin > margins[i - 1][0] and (score := (kept - below_ok) / kept + below_bad / dropped) > best:
            best, at = score, (margin + margins[i - 1][0]) / 2
        below_ok, below_bad = below_ok + ok, below_bad + (not ok)
    return at


def fit_filter(labelled: DataFrame, max_training: int = MAX_TRAINING) -> UrlFilter:
    """Fits both models and the threshold to ``(text, accepted)`` rows, or ``(url, text, accepted)``, ``text`` following from ``url``.

    At most ``max_training`` distinct URLs (texts, where there is no ``url``) of each kind are used, drawn by their hash;
    a text counts as often as there are URLs that have it. Without any of a kind its model is uniform.
    """
    rows = labelled.filter("text is not null and accepted is not null").distinct().withColumn("_draw", F.xxhash64("url" if "url" in labelled.columns else "text"))
    parts = {ok: [(r["text"], r["_draw"]) for r in rows.filter(F.col("accepted") == ok).orderBy("_draw", "text").limit(max_training).collect()] for ok in (True, False)}
    learned = {ok: [t for t, d in part if d % HELD_OUT] for ok, part in parts.items()}
    made = UrlFilter(CharModel.fit(learned[True]), CharModel.fit(learned[False]))
    made.threshold = _best_threshold([(made.margin(t), ok) for ok, part in parts.items() for t, d in part if d % HELD_OUT == 0])
    return made


def _score(model: Broadcast):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [model.value.margin(t) for t in batch.column("model_text").to_pylist()]
            yield batch.append_column("margin", pa.array(margins, pa.float64()))

    return score


def judge_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, url: str = "url", page_id: str = "page_id", max_training: int = MAX_TRAINING
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``margin`` of every row of ``pages``.

    Where a rule fits, its verdict holds; the pages it fits also teach the models, which see whole URLs but for the part
    of host and path that the rule fits (``model_text``). A null or odd URL has an empty host and path and
    is judged like any other; equal URLs get equal verdicts; no rows give no rows.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).select(
        "url", "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("ruled"),
        model_text(F.col("url"), F.col("host"), F.col("_rule.rule")).alias("model_text"),
    )
    model = fit_filter(rows.select("url", F.col("model_text").alias("text"), (F.col("ruled") == "allow").alias("accepted")), max_training)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by max_training
    schema = "page_id long, host string, path string, rule string, ruled string, model_text string, margin double"
    rows = rows.drop("url")
    verdict = F.coalesce("ruled", F.when(F.col("margin") >= model.threshold, "allow").otherwise("block"))
    return rows.mapInArrow(_score(shared), schema).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "margin")
