"""Expressions over one row's scored list, such as ``array<struct<item, score>>``.

They suit lists of a bounded length (the ``k`` recommendations of a user).
Rankings of whole histories stay in rows: see ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def items_by_score(scored: Column, item: str, score: str, k: int | None = None) -> Column:
    """Items of the list by falling score, ties by item, at most ``k`` of them."""
    ordered = F.array_sort(F.transform(scored, lambda s: F.struct((-s[score]).alias("falling"), s[item].alias("item"))))
    if k is not None:
        ordered = F.slice(ordered, 1, k)
    return F.transform(ordered, lambda s: s["item"])
