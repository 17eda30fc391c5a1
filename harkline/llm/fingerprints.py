"""Document fingerprints by consistent weighted sampling.

A document is its words with their numbers of occurrences as weights. For each of ``k`` samples and each word, a
hash of the two gives r and c from Gamma(2, 1) and b from [0, 1). With t = floor(ln w / r + b), the word's place
is ln a = ln c - r * (t - b + 1), and the sample is the smallest place of the document's words. Two documents
have the same sample with a chance equal to the generalised Jaccard similarity of their weights: the sum of the
smaller weights of each word by the sum of the larger ones. A fingerprint is ``MARK_BITS`` bits of each sample.

All of it is built-in DataFrame functions. Places of a document of weight W are exponential with rate W, so the
smallest is under ``REACH / W`` but for a chance of exp(-REACH), 1e-7. A bound below the place, from
one hash and without logarithms, leaves out words that can't get there. A sample that nothing reaches has the mark -1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harkline.llm import text as T
from harkline.operators.frozen import freeze
from harkline.operators.running import rank_within

#: Samples of a fingerprint: the standard error of a likeness of one half is a sixteenth.
SAMPLES = 64
REACH = 16.0
#: Different samples have equal marks with a chance of 1 in 65,536.
MARK_BITS = 16
_SPACE = r"\x20\x09-\x0D"
#: Longer words are cut into pieces of so many code points, so that text without spaces has terms as well.
PIECE = 16


def term_hashes(text: Column) -> Column:
    """64-bit hashes of the terms of a text, with repeats: words with A-Z as a-z, in pieces of ``PIECE``; none for null."""
    words = F.regexp_extract_all(T.lowered(F.coalesce(text, F.lit(""))), F.lit(rf"[^{_SPACE}]{{1,{PIECE}}}"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _bits(h: Column, at: int, n: int) -> Column:
    return F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << n) - 1).cast("long")).cast("double")


def samples(weighted: DataFrame, key: str, weights: dict[str, tuple[str, str]], k: int = SAMPLES) -> DataFrame:
    """The smallest places of weighted terms.

    ``weighted`` has a row per ``key`` and ``term`` (a 64-bit hash). ``weights`` maps the name of a sample to two columns,
    the term's weight (0: not there, else 1 or more) and the sum of the key's weights. Several weights share the random
    numbers of a term. Returns ``key``, ``sample`` (0 to k - 1) and a place for each name.
    """
    shares = {f"share_{name}": REACH * F.col(w) / F.greatest(F.col(total), F.lit(1)) for name, (w, total) in weights.items()}
    seeds = F.array(*[F.xxhash64("term", F.lit(i)) for i in range(k)])
    rows = weighted.select(key, *[w for w, _ in weights.values()], *[s.alias(name) for name, s in shares.items()], F.posexplode(seeds).alias("sample", "h"))
    # Sixteen leading bits of the four uniform numbers: r is under -ln(of zl), c above 1 - vh.
    lead = [_bits(F.col("h"), 16 * i, 16) for i in range(4)]
    low, high = lead[3] * lead[2] * 2.0**-32, (lead[1] + 1) * (lead[0] + 1) * 2.0**-32
    # Each weight has candidates of its own, so that its samples depend on nothing else.
    bound = (1 - high) * low
    rows = rows.filter(bound <= (F.greatest(*shares) if len(shares) > 1 else F.col(*shares)))
    rows = rows.select("*", bound.alias("bound"), *[F.xxhash64("h", F.lit(i)).alias(f"h{i}") for i in (1, 2, 3)])
    uniform = lambda i, h, at: (lead[i] + (_bits(F.col(h), at, 32) + 0.5) * 2.0**-32) * 2.0**-16
    rows = rows.select(
        key, "sample", *[F.when((F.col(w) > 0) & (F.col("bound") <= F.col(f"share_{name}")), F.ln(w)).alias(f"ln_{name}") for name, (w, _) in weights.items()],
        (-F.ln(uniform(3, "h1", 32) * uniform(2, "h1", 0))).alias("r"),
        F.ln(-F.ln(uniform(1, "h2", 32) * uniform(0, "h2", 0))).alias("ln_c"),
        ((_bits(F.col("h3"), 0, 32) + 0.5) * 2.0**-32).alias("b"),
    )
    r, b = F.col("r"), F.col("b")
    place = lambda name: F.col("ln_c") - r * (F.floor(F.col(f"ln_{name}") / r + b).cast("double") - b + 1)
    return rows.groupBy(key, "sample").agg(*[F.min(place(name)).alias(name) for name in weights])


def marks(sampled: DataFrame, key: str, names: list[str], k: int = SAMPLES) -> DataFrame:
    """``key`` and, for each name, an array of the ``k`` marks of its samples."""
    mark = lambda name: F.xxhash64(name).bitwiseAND(F.lit((1 << MARK_BITS) - 1).cast("long")).cast("int")
    by_sample = F.map_from_entries(F.collect_list(F.struct("sample", F.struct(*[F.when(F.col(n).isNotNull(), mark(n)).alias(n) for n in names]))))
    rows = sampled.groupBy(key).agg(by_sample.alias("by_sample"))
    all_of = lambda n: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at("by_sample", i)[n], F.lit(-1)))
    # A text without terms has no marks.
    return rows.select(key, *[F.when(F.exists(all_of(n), lambda m: m >= 0), all_of(n)).otherwise(F.array().cast("array<int>")).alias(n) for n in names])


def printed(marked: str | Column) -> Column:
    """Marks as a string, four hexadecimal digits each; empty without terms."""
    return F.array_join(F.transform(marked, lambda m: F.when(m < 0, F.lit("----")).otherwise(F.lower(F.lpad(F.hex(m), MARK_BITS // 4, "0")))), "")


def likeness(a: str | Column, b: str | Column) -> Column:
    """The share of samples with the same mark; 1 for two texts without terms, 0 if one has none."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1.0).otherwise(0.0)), F.lit(0.0), lambda total, x: total + x)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.coalesce(same / F.greatest(F.size(a), F.size(b)), F.lit(0.0)))


def fingerprint_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES) -> DataFrame:
    """``key`` and ``marks`` for each key; rows of one key are one text.

    A key of null or empty text has no marks. No rows give no rows.
    """
    hashed = docs.select(F.col(key).alias("key"), F.explode_outer(term_hashes(F.col(text))).alias("term"))
    counted = hashed.groupBy("key", "term").agg(F.count("term").alias("w"))
    totals = counted.groupBy(F.col("key").alias("of")).agg(F.sum("w").alias("total"))
    # Null keys are grouped with each other, so they are joined as such.
    weighted = counted.filter("w > 0").join(totals, F.col("key").eqNullSafe(F.col("of"))).select("key", "term", "w", "total")
    marked = marks(samples(weighted, "key", {"marks": ("w", "total")}, k), "key", ["marks"], k)
    joined = totals.select("of").join(marked, F.col("key").eqNullSafe(F.col("of")), "left")
    return joined.select(F.col("of").alias(key), F.coalesce("marks", F.array().cast("array<int>")).alias("marks"))


def fingerprint_edits(docs: DataFrame, k: int = SAMPLES) -> DataFrame:
    """Fingerprints of texts, and of each text whose last quarter is replaced by the start of the next document.

    ``docs`` is a stored table with ``doc_id`` and ``text``. Documents are in order of id, null ids last, those of one id by
    a hash of their text; after the last comes the first. The last floor(n_chars / 4) code points are replaced by as many of the next
    text, or all it has.

    One row per row: ``doc_id``, ``n_chars``, ``edited_sha256``; ``marks`` and ``edited_marks``; ``near_edited`` and
    ``near_next``, the likeness of ``marks`` to those of the edited and the next text. Null texts are empty; texts without
    terms have no marks. Equal texts have equal marks. No rows give no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    keys = freeze(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"),
            F.coalesce(F.length("text"), F.lit(0)).alias("size"),
        )
    )
    order = [F.col("id").asc_nulls_last(), F.col("text_key").asc(), F.col("row").asc()]
    placed = freeze(rank_within(keys, "place", order).select("row", "id", "size", "place"))
    n = placed.count()
    # Who needs how much of each row's start. Texts are dealt out by row once; both readers use that.
    taker = F.when(F.col("place") == 1, F.lit(n)).otherwise(F.col("place") - 1)
    takers = placed.select(F.col("place").alias("taker_place"), F.col("row").alias("taker"), F.floor(F.col("size") / 4).cast("int").alias("need"))
    wanted = freeze(placed.select("row", taker.alias("taker_place")).join(takers, "taker_place").select("row", "taker", "need"))
    heads = rows.join(wanted, "row").select(F.col("taker").alias("row"), F.expr("left(text, need)").alias("head"))
    # What stays is split into terms once, up to a space near its end.
    stays = F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))")
    both = rows.join(heads.hint("merge"), "row").select("row", "text", stays.alias("stays"), "head")
    tail = F.length(F.regexp_extract(F.expr("right(stays, 256)"), f"[^{_SPACE}]*$", 0))
    cut = both.withColumn("alike", F.when(tail < 256, F.length("stays") - tail).otherwise(0))
    terms = cut.select(
        "row", term_hashes(F.expr("left(text, alike)")).alias("alike"), term_hashes(F.expr("substr(text, alike + 1)")).alias("own"),
        term_hashes(F.expr("concat(substr(stays, alike + 1), head)")).alias("new"),
    )
    n_alike, n_own = F.size("alike"), F.size("own")
    listed = terms.select("row", n_alike.alias("n_alike"), (n_alike + n_own).alias("n_own"), (n_alike + F.size("new")).alias("n_new"), F.posexplode(F.concat("alike", "own", "new")).alias("at", "term"))
    own, new = F.col("at") < F.col("n_own"), (F.col("at") < F.col("n_alike")) | (F.col("at") >= F.col("n_own"))
    weighted = listed.groupBy("row", "n_own", "n_new", "term").agg(F.count_if(own).alias("own"), F.count_if(new).alias("new"))
    marked = marks(samples(weighted, "row", {"marks": ("own", "n_own"), "edited_marks": ("new", "n_new")}, k), "row", ["marks", "edited_marks"], k)
    none = F.array().cast("array<int>")
    told = both.select("row", F.length("text").alias("n_chars"), F.sha2(F.concat("stays", "head"), 256).alias("edited_sha256")).join(marked, "row", "left")
    told = told.withColumns({"marks": F.coalesce("marks", none), "edited_marks": F.coalesce("edited_marks", none)})
    prints = freeze(told)
    # The row a row's start is wanted by is the one before it.
    following = wanted.join(prints.select("row", F.col("marks").alias("next_marks")), "row").select(F.col("taker").alias("row"), "next_marks")
    out = placed.select("row", "id").join(prints, "row").join(following, "row")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "marks", "edited_marks",
        likeness("marks", "edited_marks").alias("near_edited"), likeness("marks", "next_marks").alias("near_next"),
    )
