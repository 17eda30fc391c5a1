"""Token counts as rollups that are kept up by deltas.

A batch is a set of signed rows: an insert adds a document's counts, a delete takes them away, and a
revised count is a delete of the old and an insert of the new. Counts add up, so a batch is stored
as its totals by source, language and tokenizer version, and the rollup is the sum over batches.

A batch has a name and is committed once. Its totals are written to a folder of its own beside
the others and then renamed to ``batch=<name>``; the rename happens or doesn't, so a batch that broke off
is not seen and can be committed again, and one that is there is not counted again.
"""

from __future__ import annotations

from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.llm.text import word_count

KEYS = ["source", "lang", "tokenizer"]
TOTALS = ["n_docs", "n_tokens"]
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


class TokenRollup:
    """A rollup in a folder that all executors share. Batches are committed by one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        return self._files().exists(self._path(f"batch={quote(batch, safe='')}"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds ``changes`` unless the batch is there already; says whether it did.

        ``changes`` has the columns of ``KEYS``, ``sign`` (1 or -1) and ``tokens``. Null keys are values like
        any other; a null sign or count adds nothing. Rows count as often as they occur.
        """
        if self.committed(batch):
            return False
        sign = F.coalesce("sign", F.lit(0)).cast("long")
        totals = changes.groupBy(*KEYS).agg(
            F.sum(sign).alias("n_docs"), F.sum(sign * F.coalesce("tokens", F.lit(0)).cast("long")).alias("n_tokens")
        )
        written = f"writing-{uuid4().hex}"
        totals.write.parquet(f"{self.folder}/{written}")
        if not self._files().rename(self._path(written), self._path(f"batch={quote(batch, safe='')}")):
            raise OSError(f"batch {batch} could not be put in place")
        return True

    def totals(self) -> DataFrame:
        """The sums over all batches, without keys whose documents are all gone. No batches give no rows."""
        found = self._files().globStatus(self._path("batch=*")) or []
        paths = [f.getPath().toString() for f in found]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        batches = self.spark.read.schema(_SCHEMA).parquet(*paths)
        sums = batches.groupBy(*KEYS).agg(*[F.sum(t).alias(t) for t in TOTALS])
        return sums.filter("n_docs <> 0 or n_tokens <> 0")


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, keys and ``tokens`` of every document, once for each way of counting.

    ``words-1`` counts words and ``bytes-1`` UTF-8 bytes; a null text has none of either.
    """
    counts = F.array(
        F.struct(F.lit("words-1").alias("tokenizer"), word_count(text).alias("tokens")),
        F.struct(F.lit("bytes-1").alias("tokenizer"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("tokens")),
    )
    return docs.select("doc_id", "source", "lang", F.explode(counts).alias("c")).select("doc_id", "source", "lang", "c.tokenizer", "c.tokens")
