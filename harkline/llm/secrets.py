"""Secret scans: what looks like a credential, and who else has the same one.

Candidates are found by pattern. Each value's hash is counted over the corpus by distinct owners
and repositories: a value that many owners have is an example copied from somewhere, one that a single
owner or two have looks live. Values of the named kinds are always reported; long tokens of no named
kind are reported where they are an owner's own.

All of it is built-in DataFrame functions. Only hashes are shuffled, never texts or values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from harkline.operators.frozen import freeze


@dataclass(frozen=True)
class Kind:
    """A kind of candidate: its pattern, the group that is the secret, and the least length of that group.

    ``hint`` is a cheaper pattern that any text with a candidate has.
    """

    name: str
    pattern: str
    group: int
    least: int
    hint: str


_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Fixed patterns. Hexadecimal and access candidates that are too short can't hold a longer one, so the least
#: length is part of the pattern; a failed assignment uses up its text, so it is matched and dropped.
BASE = (
    Kind("assign", _ASSIGN, 2, 8, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
    Kind("access", r"(AKIA[A-Z0-9]{12,})", 1, 16, r"AKIA[A-Z0-9]{12}"),
    Kind("hex", r"([0-9a-f]{32,})", 1, 32, r"[0-9a-f]{32}"),
)
#: Long tokens of letters and digits.
OWNED = Kind(
    "owned", r"((?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,})", 1, 20, r"[A-Za-z0-9_-]{20}"
)
#: A value that more owners than this have is an example.
MAX_OWNERS = 2


def pieces(text: Column, kind: Kind, number: int) -> Column:
    """The candidates of a kind in a text, in order: the characters before each since the last, its own, and its value's length and hash."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    secret = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    step = F.zip_with(F.split(text, kind.pattern, -1), whole, lambda piece, match: F.struct(F.length(piece).alias("gap"), F.length(match).alias("long")))
    parts = F.zip_with(
        step, secret,
        lambda s, v: F.struct(
            F.lit(number).alias("kind"), s["gap"].alias("gap"), s["long"].alias("long"), F.length(v).alias("size"), F.xxhash64(v).alias("value")
        ),
    )
    none = F.array().cast("array<struct<kind:int,gap:int,long:int,size:int,value:bigint>>")
    return F.when(text.rlike(kind.hint), F.filter(parts, lambda p: p["long"].isNotNull())).otherwise(none)


def located(pieced: DataFrame, kinds: list[Kind]) -> DataFrame:
    """``(row, owner, repository, span)``: the candidates that are long enough, with ``start``, ``kind``, ``end`` in characters, end exclusive, ``size`` and ``value``.

    Places are running sums of the pieces of a text, and a long token is left out that overlaps one of a named kind: before it by the
    largest end, after it by the smallest start. So the work follows the number of candidates, however many one text has.
    """
    listed = pieced.select("row", "owner", "repository", F.posexplode("pieces").alias("at", "piece")).select("row", "owner", "repository", "at", "piece.*")
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.array(*[F.lit(k.least) for k in kinds]), F.col("kind") + 1)
    placed = listed.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(upto).cast("int")).filter(F.col("size") >= least)
    placed = placed.withColumn("start", F.col("end") - F.col("long"))
    # Both ways as running values; a window that ends with the text would be added up anew for each row.
    rising, falling = (Window.partitionBy("row").orderBy(*o).rowsBetween(Window.unboundedPreceding, 0) for o in (("start", "kind"), (F.desc("start"), F.desc("kind"))))
    named = F.col("kind") < len(BASE)
    reached = F.max(F.when(named, F.col("end"))).over(rising)
    following = F.min(F.when(named, F.col("start"))).over(falling)
    overlaps = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    placed = placed.withColumn("taken", overlaps).filter(named | ~F.col("taken"))
    return placed.select("row", "owner", "repository", F.struct("start", "kind", "end", "size", "value").alias("span"))


def _listed(spans: Column, kinds: list[Kind]) -> Column:
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(
    docs: DataFrame, owner: Column | None = None, repository: Column | None = None, max_owners: int = MAX_OWNERS
) -> DataFrame:
    """The candidates of every document; ``docs`` has ``doc_id`` and ``text``.

    ``owner`` is the document's ``source`` unless given, ``repository`` its source and language.

    One row per row of ``docs``: ``doc_id``; ``base``, the spans of the named kinds, and ``spans``, those and the
    owner's own long tokens, both as ``kind:start:end`` by start and kind, joined by commas; ``n_assign``, ``n_access``,
    ``n_hex``; ``n_live``, spans of values that at most ``max_owners`` owners have; ``n_copied``, the others.

    A null or empty text has none, a null owner or repository is one of its own. Equal rows get
    equal results, and count once as an owner. No rows give no rows.
    """
    kinds = [*BASE, OWNED]
    text = F.coalesce("text", F.lit(""))
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    found = F.concat(*[pieces(text, k, i) for i, k in enumerate(kinds)])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), found.alias("pieces")
    )
    rows = freeze(rows)
    values = freeze(located(rows.filter(F.size("pieces") > 0), kinds))
    # Each owner and repository of a value counts once, so that no value is gathered whole.
    owners = values.groupBy(F.col("span.value").alias("value"), "owner", "repository").agg(F.lit(1).alias("one"))
    owners = owners.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    owners = owners.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    # A value that is copied widely stands in many rows; the join splits such a partition.
    judged = values.join(owners, F.col("span.value") == F.col("value")).select(
        "row", "span", (F.col("owners") <= max_owners).alias("live"), "owners", "repositories"
    )
    of_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("live") | (F.col("span.kind") < len(BASE)), F.col("span")))).alias("kept"),
        *[F.count_if(F.col("span.kind") == i).alias(f"n_{k.name}") for i, k in enumerate(BASE)],
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"), F.max("owners").alias("max_owners"), F.max("repositories").alias("max_repositories"),
    )
    base = F.filter("kept", lambda s: s["kind"] < len(BASE))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("row", "doc_id").join(of_row, "row", "left").select(
        "doc_id", *[zero(f"n_{k.name}") for k in BASE], F.coalesce(_listed(base, kinds), F.lit("")).alias("base"),
        F.coalesce(_listed(F.col("kept"), kinds), F.lit("")).alias("spans"), zero("n_live"), zero("n_copied"), zero("max_owners"), zero("max_repositories"),
    )
