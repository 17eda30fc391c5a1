"""Queries over track features and genre labels."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.operators import clean, correlate, features, profile
from harkline.operators.frozen import freeze
from harkline.plans import tables as t
from harkline.plans.tables import FEATURES, Query, with_sql

SUMMARY_DIGITS = {"mean": 7, "stddev": 5, "min": 8, "max": 8}


def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = profile.feature_summary(t.feature_table(spark, sf), FEATURES)
    return summary.select("feature", "n", *[F.round(s, d).alias(s) for s, d in SUMMARY_DIGITS.items()])


def feature_correlation(spark: SparkSession, sf: str) -> DataFrame:
    correlations = correlate.feature_correlation(t.feature_table(spark, sf), FEATURES)
    return correlations.withColumn("corr", F.round("corr", 6))


def high_correlation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.high_correlation_pairs(correlate.feature_correlation(t.feature_table(spark, sf), FEATURES))


def wide_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Correlations of every pair of embedding dimensions, by the vector route."""
    wide = wide_features(spark, sf)
    return correlate.feature_correlation(wide, wide.columns).withColumn("corr", F.round("corr", 6))


def wide_features(spark: SparkSession, sf: str) -> DataFrame:
    """A column for each place of the embeddings, which must all be of one length."""
    embeddings = t.table(spark, sf, "embeddings")
    shortest, longest = embeddings.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).head()
    if shortest != longest:
        raise ValueError(f"embeddings are {shortest} to {longest} long")
    at = range(1, (longest or 0) + 1)
    return embeddings.select(*[F.get("embedding", F.lit(i - 1)).cast("double").alias(f"v{i:02d}") for i in at])


def wide_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of more columns than one plan holds side by side: every embedding dimension and two whole numbers."""
    lines = profile.feature_summary(t.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    wide = wide_features(spark, sf)
    summary = profile.feature_summary(wide, wide.columns).unionByName(lines)
    return summary.select("feature", "n", *[F.round(s, 6).alias(s) for s in ("mean", "stddev", "min", "max")])


def assembled(spark: SparkSession, sf: str) -> DataFrame:
    """The feature vector of each labelled track, one row per element."""
    tracks = t.labelled_features(spark, sf)
    vectors = features.assemble(tracks, features.feature_columns(tracks, ["track_id", "genre"]))
    return vectors.select(
        "track_id", F.posexplode(vector_to_array("features")).alias("at", "value")
    )


def genre_index(spark: SparkSession, sf: str) -> DataFrame:
    tracks = freeze(t.labelled_features(spark, sf).select("genre"))
    return features.frequency_index(tracks, "genre", "class").select("genre", "class")


_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{i}' AS i, '{j}' AS j, corr({i}, {j}) AS corr FROM features"
    for a, i in enumerate(FEATURES)
    for j in FEATURES[a + 1 :]
)

def partly_labelled_features(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled features where a third of the tracks have no genre: those are left out."""
    sized = t.table(spark, sf, "part").filter(F.col("p_size") % 3 != 0)
    labelled = clean.label_features(t.genres_of(sized), clean.normalize_track_id(t.feature_table(spark, sf)))
    return labelled.select("track_id", "genre", "n", "sp")


QUERIES = {
    "feature_table": Query(t.feature_table, with_sql("SELECT * FROM features")),
    "normalize_track_id": Query(
        lambda spark, sf: clean.normalize_track_id(t.feature_table(spark, sf)),
        with_sql("SELECT * FROM plain_features"),
    ),
    "labelled_features": Query(t.labelled_features, with_sql("SELECT * FROM labelled")),
    "partly_labelled_features": Query(
        partly_labelled_features,
        with_sql("""SELECT track_id, genre, n, sp FROM labelled
            WHERE track_id IN (SELECT lpad(CAST(p_partkey AS VARCHAR), 18, 'T00000000000000000') FROM part WHERE p_size % 3 <> 0)"""),
    ),
    "genre_counts": Query(
        lambda spark, sf: profile.group_counts(t.genres(spark, sf), "genre").orderBy("n_rows", "genre"),
        with_sql("SELECT genre, count(*) AS n_rows FROM genres GROUP BY genre ORDER BY n_rows, genre"),
    ),
    "genre_index": Query(genre_index, with_sql("SELECT * FROM genre_index")),
    "binary_label": Query(
        lambda spark, sf: t.binary_tracks(spark, sf).select("track_id", "genre", "class"),
        with_sql("SELECT track_id, genre, class FROM binary_tracks"),
    ),
    "class_balance": Query(
        lambda spark, sf: profile.class_balance(t.binary_tracks(spark, sf)),
        with_sql("""SELECT class, count(*) AS count, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 3) AS ratio
            FROM binary_tracks GROUP BY class ORDER BY class"""),
    ),
    "class_balance_multi": Query(
        lambda spark, sf: profile.class_balance(t.genre_tracks(spark, sf)),
        with_sql("""SELECT class, count(*) AS count, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 3) AS ratio
            FROM genre_tracks GROUP BY class ORDER BY class"""),
    ),
    "feature_summary": Query(
        feature_summary,
        with_sql(
            " UNION ALL ".join(
                f"""SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 7) AS mean,
                    round(stddev_samp({c}), 5) AS stddev, round(min({c}), 8) AS min, round(max({c}), 8) AS max FROM features"""
                for c in FEATURES
            )
        ),
    ),
    "feature_correlation": Query(
        feature_correlation,
        with_sql("SELECT i, j, round(corr, 6) AS corr FROM pairs", pairs=_PAIRS_SQL),
    ),
    "high_correlation_pairs": Query(
        high_correlation_pairs,
        with_sql("SELECT i, j, round(corr, 3) AS corr FROM pairs WHERE corr > 0.7 AND corr < 1", pairs=_PAIRS_SQL),
    ),
    "wide_correlation": Query(
        wide_correlation,
        """WITH long AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS at
                FROM embeddings)
            SELECT 'v' || lpad(a.at::VARCHAR, 2, '0') AS i, 'v' || lpad(b.at::VARCHAR, 2, '0') AS j,
                round(corr(a.v, b.v), 6) AS corr
            FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.at < b.at GROUP BY a.at, b.at""",
    ),
    "wide_summary": Query(
        wide_summary,
        """WITH long AS (
              SELECT 'v' || lpad(generate_subscripts(embedding, 1)::VARCHAR, 2, '0') AS feature, unnest(embedding)::DOUBLE AS v FROM embeddings
              UNION ALL SELECT 'l_orderkey', l_orderkey FROM lineitem UNION ALL SELECT 'l_linenumber', l_linenumber FROM lineitem)
            SELECT feature, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS stddev, round(min(v), 6) AS min, round(max(v), 6) AS max
            FROM long GROUP BY feature""",
    ),
    "assembled": Query(
        assembled,
        with_sql(
            " UNION ALL ".join(
                f"SELECT track_id, {at} AS at, {c}::DOUBLE AS value FROM labelled" for at, c in enumerate(FEATURES)
            )
        ),
    ),
}
