"""Labels, indexes and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F, types as T

from harkline.operators.joins import lookup_join
from harkline.operators.profile import group_counts
from harkline.operators.running import rank_within

# The labels that a fitted indexer holds, on the driver and in every task.
MAX_LABELS = 10_000


def feature_columns(df: DataFrame, ids: Sequence[str]) -> list[str]:
    """All columns but ``ids``; each must be numeric."""
    fields = [f for f in df.schema if f.name not in ids]
    wrong = [f.name for f in fields if not isinstance(f.dataType, T.NumericType)]
    if wrong:
        raise TypeError(f"not numeric: {wrong}")
    return [f.name for f in fields]


def assemble(df: DataFrame, columns: Sequence[str], handle_invalid: str = "error") -> DataFrame:
    """Replaces ``columns`` by one ``features`` vector."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid=handle_invalid)
    return vectors.transform(df).drop(*columns)


def binary_label(df: DataFrame, genre: str, column: str = "genre") -> DataFrame:
    """Adds ``class``: 1 for the genre, else 0."""
    return df.withColumn("class", F.when(F.col(column) == genre, 1).otherwise(0))


def label_indexer(df: DataFrame, column: str, output: str = "class") -> StringIndexerModel:
    """A model that indexes a label set by falling frequency, ties by label, for fits that must know the label names.

    Where only the index is needed, ``frequency_index`` and ``apply_index`` give the same one without a bound.
    """
    counts = group_counts(df.filter(F.col(column).isNotNull()), column)
    rows = counts.orderBy(F.desc("n_rows"), column).select(column).limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"{column} has more than {MAX_LABELS} values; use frequency_index")
    return StringIndexerModel.from_labels([row[0] for row in rows], inputCol=column, outputCol=output)


def frequency_index(df: DataFrame, column: str, output: str) -> DataFrame:
    """``(column, n_rows, output)``: an index from 0 by falling frequency, ties by value.

    For ids without a bound on their number: the index is a table, and no task or
    driver holds it whole.
    """
    ranked = rank_within(group_counts(df, column), "_rank", [F.desc("n_rows"), F.asc(column)])
    return ranked.select(column, "n_rows", (F.col("_rank") - 1).cast("int").alias(output))


def apply_index(df: DataFrame, index: DataFrame, column: str) -> DataFrame:
    """Adds the index of ``column`` from a stored ``index``; rows with a value it does not know are dropped."""
    return lookup_join(df, index.drop("n_rows"), column, "inner", stored=True)
