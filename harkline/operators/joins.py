"""Joins from a large table to a lookup of unique keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from harkline.operators.frozen import freeze

# A lookup of up to this many bytes is broadcast.
BROADCAST_BYTES = 32 << 20
# Rows of one key that one task should read at most; a key with more is spread over several.
TASK_ROWS = 5_000_000
# Keys that are spread are fewer than this; if more have too many rows, those with most are.
SPREAD_KEYS = 500_000

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of all values of a table: eight for a number, the length of what is written out for others."""
    sizes = [F.lit(8) if isinstance(f.dataType, _FIXED) else F.coalesce(F.length(F.to_json(F.struct(f.name))), F.lit(0)) for f in df.schema]
    return df.agg(F.sum(sum(sizes, F.lit(0)).cast("long"))).head()[0] or 0


def common_type(one: T.DataType, other: T.DataType) -> str:
    """The type in which keys of two types are compared: their own, or the wider of two number types.

    Other pairs are refused, as what they compare as depends on the session.
    """
    if one == other:
        return one.simpleString()
    if not (isinstance(one, T.NumericType) and isinstance(other, T.NumericType)):
        raise TypeError(f"keys of types {one.simpleString()} and {other.simpleString()}: cast one first")
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if one in whole and other in whole:
        return max(one, other, key=whole.index).simpleString()
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (one, other)):
        return "double"
    digits = [(20, 0) if t in whole else (t.precision, t.scale) for t in (one, other)]
    scale = max(s for _, s in digits)
    return f"decimal({min(38, max(p - s for p, s in digits) + scale)},{scale})"


def _hash(names: list[str]) -> Column:
    return F.xxhash64(*names)


def spread_keys(facts: DataFrame, keys: list[str], task_rows: int) -> DataFrame:
    """``(_hash, _salts)`` of the keys with more than ``task_rows`` rows, fewer than ``SPREAD_KEYS``.

    Rows are counted by key in each task before they are moved. Keys that share a hash are spread together.
    """
    counts = freeze(facts.groupBy(_hash(keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > task_rows))
    rows = counts.agg(F.sum("_n")).head()[0] or 0
    least = max(task_rows, rows // SPREAD_KEYS)
    return counts.filter(F.col("_n") > least).select("_hash", F.ceil(F.col("_n") / least).cast("int").alias("_salts"))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str,
    stored: bool = False,
    max_bytes: int | None = None,
    task_rows: int = TASK_ROWS,
    facts_stored: bool = False,
) -> DataFrame:
    """``facts.join(lookup, on, how)`` for a ``lookup`` with one row per key.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. Keys of two number types are compared in the
    wider one; other unequal types are refused. Either way the key comes out as ``facts`` has it.

    Unless it is ``stored`` already (a table, or a plain scan of one), the lookup is
    written down first, so that it is computed once. Its size is then checked. A
    small one is broadcast and the facts do not move. Otherwise both sides are
    shuffled, and the rows of each key with more than ``task_rows`` are spread over as many
    values as that takes, by their place in the table, with the lookup's row repeated for each. Keys are counted for that, so facts that
    are not ``facts_stored`` (a table, or a plain scan of one) are written down before. Where no key has so many rows, it is a plain join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    types = {k: common_type(facts.schema[k].dataType, lookup.schema[k].dataType) for k in keys}
    if not stored:
        lookup = freeze(lookup)
    small = stored_bytes(lookup) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)
    if not small and not facts_stored:
        facts = freeze(facts)

    match = [f"_key_{i}" for i in range(len(keys))]
    others = [c for c in lookup.columns if c not in keys]
    left = facts.select("*", *[F.col(k).cast(types[k]).alias(m) for k, m in zip(keys, match)])
    right = lookup.select(*[F.col(k).cast(types[k]).alias(m) for k, m in zip(keys, match)], *others)
    if small:
        joined = left.join(F.broadcast(right), match, how)
    elif (spread := freeze(spread_keys(left, match, task_rows))).isEmpty():
        joined = left.join(right, match, how)
    else:
        spread = F.broadcast(spread)  # fewer than SPREAD_KEYS rows
        left = left.withColumn("_hash", _hash(match)).join(spread, "_hash", "left")
        left = left.withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.monotonically_increasing_id(), "_salts")).otherwise(0).cast("int"))
        right = right.withColumn("_hash", _hash(match)).join(spread, "_hash", "left").drop("_hash")
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
        joined = left.join(right, [*match, "_salt"], how)
    out = [*keys, *[c for c in facts.columns if c not in keys]]
    return joined.select(*out, *(others if how in ("inner", "left") else []))

