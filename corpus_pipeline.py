"""The stages a corpus passes on its way to a training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.llm import decontaminate, jaccard, lines, mixing, quality
from harkline.operators.frozen import freeze
from harkline.plans.tables import Query, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur earlier, and without those that consist of such runs."""
    left = lines.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return jaccard.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    items = decontaminate.question_and_answer(table(spark, sf_dir, "benchmark"))
    return decontaminate.drop_contaminated(docs, items)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is used, so that sources reach their weights."""
    return mixing.mix_sources(docs).select(
        "doc_id", F.col("mix_sources")[0].alias("source"), F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_copies").alias("copies"), F.col("mix_taken").alias("taken"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mix),
]
#: The stages measure distances from the corpus and follow chains of near copies; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": Query(run, ORACLE_SQL)}
