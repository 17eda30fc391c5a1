"""The datasets of a music data folder, by name, and what files it holds."""

from __future__ import annotations

import re

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.sources import text
from harkline.sources.attributes import load_features

# Names of the published feature sets.
FEATURE_SETS = {
    "area_of_moments": "msd-jmir-area-of-moments-all-v1.0",
    "lpc": "msd-jmir-lpc-all-v1.0",
    "methods_of_moments": "msd-jmir-methods-of-moments-all-v1.0",
    "mfcc": "msd-jmir-mfcc-all-v1.0",
    "spectral": "msd-jmir-spectral-all-all-v1.0",
    "spectral_derivatives": "msd-jmir-spectral-derivatives-all-all-v1.0",
    "timbral": "msd-marsyas-timbral-v1.0",
    "mvd": "msd-mvd-v1.0",
    "rh": "msd-rh-v1.0",
    "rp": "msd-rp-v1.0",
    "ssd": "msd-ssd-v1.0",
    "trh": "msd-trh-v1.0",
    "tssd": "msd-tssd-v1.0",
}

# Places of the other published files below the data folder.
GENRE_FILES = {
    "genre": "genre/msd-MAGD-genreAssignment.tsv",
    "top_genre": "genre/msd-topMAGD-genreAssignment.tsv",
    "style": "genre/msd-MASD-styleAssignment.tsv",
}
HEADER_FILES = {
    "statistics": "audio/statistics/sample_properties.csv.gz",
    "analysis": "main/summary/analysis.csv.gz",
    "metadata": "main/summary/metadata.csv.gz",
}
TRIPLETS = "tasteprofile/triplets.tsv"
MISMATCHES = "tasteprofile/mismatches/sid_mismatches.txt"


@dataclass(frozen=True)
class Catalogue:
    """Loads each dataset below ``root`` by name."""

    spark: SparkSession
    root: str

    def names(self) -> list[str]:
        return [*FEATURE_SETS, *GENRE_FILES, *HEADER_FILES, "triplets", "mismatches"]

    def load(self, name: str) -> DataFrame:
        if name in FEATURE_SETS:
            return load_features(self.spark, f"{self.root}/audio", FEATURE_SETS[name])
        if name in GENRE_FILES:
            return text.read_genres(self.spark, f"{self.root}/{GENRE_FILES[name]}")
        if name in HEADER_FILES:
            return text.read_delimited(self.spark, f"{self.root}/{HEADER_FILES[name]}", header=True)
        if name == "triplets":
            return text.read_triplets(self.spark, f"{self.root}/{TRIPLETS}")
        if name == "mismatches":
            return text.parse_mismatches(text.read_lines(self.spark, f"{self.root}/{MISMATCHES}"))
        raise KeyError(name)

    def load_untyped(self, name: str) -> DataFrame:
        """A feature set or triplets as they lie: string columns ``_c0``, ``_c1``, and so on."""
        if name in FEATURE_SETS:
            return text.read_delimited(self.spark, f"{self.root}/audio/features/{FEATURE_SETS[name]}.csv")
        if name == "triplets":
            return text.read_delimited(self.spark, f"{self.root}/{TRIPLETS}", sep="\t")
        raise KeyError(name)


def file_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: path, folder, depth, length and time; contents are not read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    below = F.regexp_replace(F.col("path"), f"^{re.escape(whole)}/", "")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            below.alias("path"),
            F.regexp_extract(below, "^(.*)/[^/]*$", 1).alias("folder"),
            F.size(F.split(below, "/")).alias("depth"),
            "length",
            "modificationTime",
        )
    )


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
