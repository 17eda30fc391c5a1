"""Queries over play triplets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.operators import clean, profile, sketches
from harkline.operators.frozen import freeze
from harkline.plans import tables as t
from harkline.plans.tables import MIN_PLAYS, MIN_SONGS, Query, with_sql
from harkline.sources.catalogue import preview

BINS = 20
POINTS = 100
SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


def top_listeners(spark: SparkSession, sf: str) -> DataFrame:
    """The ten users with most plays of songs that are not mismatched."""
    return (
        t.clean_triplets(spark, sf)
        .groupBy("user_id")
        .agg(F.sum("play_count").alias("total_plays"), F.countDistinct("song_id").alias("n_songs"))
        .orderBy(F.desc("total_plays"), "user_id")
        .limit(10)
    )


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    datasets = {name: t.table(spark, sf, name) for name in t.TABLES}
    datasets |= {
        "triplets": t.triplets(spark, sf),
        "clean_triplets": t.clean_triplets(spark, sf),
        "mismatches": t.mismatches(spark, sf),
    }
    return profile.row_counts(datasets)


def sketched_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Users and songs counted from sketches of ten parts (by the last digit of the song), and whether that is within four standard errors."""
    triplets = t.stored_triplets(spark, sf)
    parts = freeze(sketches.distinct_sketches(triplets.withColumn("part", F.substring("song_id", -1, 1)), ["song_id", "user_id"], "part"))
    exact = profile.distinct_counts(triplets, ["song_id", "user_id"]).withColumnRenamed("n_distinct", "exact")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 4 * sketches.STANDARD_ERROR * F.col("exact") + 1
    return sketches.merged_distinct(parts).join(exact, "column").select("column", "n_parts", "exact", near.alias("near"))


def popularity_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.histogram(profile.total_plays(t.clean_triplets(spark, sf), "song_id"), "total_plays", BINS)


def activity_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    activity = profile.total_plays(t.clean_triplets(spark, sf), "user_id")
    return profile.exact_percentiles(activity, "total_plays", SHARES).withColumn("value", F.round("value", 6))


def activity_density(spark: SparkSession, sf: str) -> DataFrame:
    activity = profile.total_plays(t.clean_triplets(spark, sf), "user_id")
    curve = profile.density(activity, "total_plays", POINTS)
    return curve.select(F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


_DENSITY = with_sql(
    f"""SELECT round(x, 6) AS x,
            round(sum(exp(-pow((x - v) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
        FROM activity JOIN points ON true GROUP BY x""",
    activity="SELECT sum(play_count)::DOUBLE AS v FROM clean_triplets GROUP BY user_id",
    shape="""SELECT count(*) AS n, min(v) AS lo, max(v) - min(v) AS span,
        stddev_samp(v) * pow(count(*), -0.2::DOUBLE) AS h FROM activity""",
    points=f"""SELECT lo - span / 2 + i * 2 * span / {POINTS - 1} AS x, n, h
        FROM shape JOIN (SELECT unnest(range({POINTS})) AS i) ON true""",
)
_HISTOGRAM = with_sql(
    f"""SELECT bin, round(lo + (bin - 1) * span / {BINS}::DOUBLE, 6) AS low,
               round(lo + bin * span / {BINS}::DOUBLE, 6) AS high, count(*) AS n
        FROM binned GROUP BY bin, lo, span""",
    popularity="SELECT sum(play_count)::BIGINT AS v FROM clean_triplets GROUP BY song_id",
    bounds="SELECT min(v) AS lo, max(v) - min(v) AS span FROM popularity",
    binned=f"""SELECT lo, span,
            least({BINS}, floor((v - lo) * {BINS} / (CASE WHEN span = 0 THEN 1 ELSE span END)::DOUBLE) + 1)::BIGINT AS bin
        FROM popularity JOIN bounds ON true""",
)

QUERIES = {
    "top_listeners": Query(
        top_listeners,
        with_sql("""SELECT user_id, CAST(sum(play_count) AS BIGINT) AS total_plays, count(DISTINCT song_id) AS n_songs
            FROM clean_triplets GROUP BY user_id ORDER BY total_plays DESC, user_id LIMIT 10"""),
    ),
    "triplets": Query(t.triplets, with_sql("SELECT * FROM triplets")),
    "parse_mismatches": Query(t.mismatches, with_sql("SELECT * FROM mismatches")),
    "clean_triplets": Query(t.clean_triplets, with_sql("SELECT * FROM clean_triplets")),
    "row_counts": Query(
        row_counts,
        with_sql(
            " UNION ALL ".join(
                f"SELECT '{name}' AS dataset, count(*) AS n_rows FROM {name}"
                for name in [*t.TABLES, "triplets", "clean_triplets", "mismatches"]
            )
        ),
    ),
    "distinct_counts": Query(
        lambda spark, sf: profile.distinct_counts(t.clean_triplets(spark, sf), ["song_id", "user_id"]),
        with_sql("""SELECT 'song_id' AS "column", count(DISTINCT song_id) AS n_distinct FROM clean_triplets
            UNION ALL SELECT 'user_id', count(DISTINCT user_id) FROM clean_triplets"""),
    ),
    "sketched_distinct": Query(
        sketched_distinct,
        with_sql("""SELECT 'song_id' AS "column", count(DISTINCT substr(song_id, -1)) AS n_parts, count(DISTINCT song_id) AS exact, true AS near FROM clean_triplets
            UNION ALL SELECT 'user_id', count(DISTINCT substr(song_id, -1)), count(DISTINCT user_id), true FROM clean_triplets"""),
    ),
    "song_popularity": Query(
        lambda spark, sf: profile.total_plays(t.clean_triplets(spark, sf), "song_id"),
        with_sql("SELECT song_id, CAST(sum(play_count) AS BIGINT) AS total_plays FROM clean_triplets GROUP BY song_id"),
    ),
    "user_activity": Query(
        lambda spark, sf: profile.total_plays(t.clean_triplets(spark, sf), "user_id"),
        with_sql("SELECT user_id, CAST(sum(play_count) AS BIGINT) AS total_plays FROM clean_triplets GROUP BY user_id"),
    ),
    "most_active_user": Query(
        lambda spark, sf: profile.most_active_user(t.clean_triplets(spark, sf)),
        with_sql("""SELECT user_id, CAST(sum(play_count) AS BIGINT) AS total_plays FROM clean_triplets
            GROUP BY user_id ORDER BY total_plays DESC, user_id LIMIT 1"""),
    ),
    "user_rows": Query(
        lambda spark, sf: profile.most_active_rows(t.stored_triplets(spark, sf)),
        with_sql("""SELECT * FROM clean_triplets WHERE user_id = (
            SELECT user_id FROM clean_triplets GROUP BY user_id ORDER BY sum(play_count) DESC, user_id LIMIT 1)"""),
    ),
    "top_user_share": Query(
        lambda spark, sf: profile.top_user_share(t.stored_triplets(spark, sf)),
        with_sql("""SELECT n_songs, n_catalogue, round(n_songs / n_catalogue::DOUBLE * 100, 6) AS percent FROM (
            SELECT (SELECT count(*) FROM clean_triplets WHERE user_id = (
                SELECT user_id FROM clean_triplets GROUP BY user_id ORDER BY sum(play_count) DESC, user_id LIMIT 1)) AS n_songs,
            (SELECT count(DISTINCT song_id) FROM clean_triplets) AS n_catalogue)"""),
    ),
    "popularity_histogram": Query(popularity_histogram, _HISTOGRAM),
    "activity_density": Query(activity_density, _DENSITY),
    "activity_percentiles": Query(
        activity_percentiles,
        with_sql(
            " UNION ALL ".join(
                f"""SELECT {share}::DOUBLE AS share, round(quantile_cont(total::DOUBLE, {share}), 6) AS value
                    FROM (SELECT sum(play_count) AS total FROM clean_triplets GROUP BY user_id)"""
                for share in SHARES
            )
        ),
    ),
    "low_play_songs": Query(
        lambda spark, sf: clean.low_play_songs(t.clean_triplets(spark, sf), MIN_PLAYS),
        with_sql("SELECT * FROM low_plays"),
    ),
    "low_song_users": Query(
        lambda spark, sf: clean.low_song_users(t.clean_triplets(spark, sf), MIN_SONGS),
        with_sql("SELECT * FROM low_songs"),
    ),
    "drop_low_play_songs": Query(
        lambda spark, sf: clean.drop_low_play_songs(t.stored_triplets(spark, sf), MIN_PLAYS),
        with_sql("SELECT * FROM played"),
    ),
    "active_subset": Query(t.active_triplets, with_sql("SELECT * FROM active")),
    "distinct_users": Query(
        lambda spark, sf: t.triplets(spark, sf).select("user_id").distinct(),
        with_sql("SELECT DISTINCT user_id FROM triplets"),
    ),
    "preview": Query(
        lambda spark, sf: preview(t.triplets(spark, sf), ["user_id", "song_id"]),
        with_sql("SELECT * FROM triplets ORDER BY user_id, song_id LIMIT 10"),
    ),
}
