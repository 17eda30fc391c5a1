"""Cleaning play triplets and joining labels to features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harkline.functions import ids
from harkline.operators.frozen import freeze
from harkline.operators.joins import lookup_join


def drop_mismatched(triplets: DataFrame, mismatches: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """Triplets whose song is not on the mismatch list.

    Pairs of ``accepted`` (song and track ids approved by hand) are taken off the list first.
    """
    if accepted is not None:
        mismatches = mismatches.join(accepted, ["song_id", "track_id"], "left_anti")
    return lookup_join(triplets, mismatches.select("song_id"), "song_id", "left_anti", stored=accepted is None)


def low_play_songs(triplets: DataFrame, min_plays: int = 100) -> DataFrame:
    """Songs with fewer than ``min_plays`` plays in total."""
    return (
        triplets.groupBy("song_id")
        .agg(F.sum("play_count").alias("total_plays"))
        .filter(F.col("total_plays") < min_plays)
    )


def low_song_users(triplets: DataFrame, min_songs: int = 30, distinct_songs: bool = False) -> DataFrame:
    """Users with fewer than ``min_songs`` rows (or distinct songs)."""
    songs = F.countDistinct("song_id") if distinct_songs else F.count(F.lit(1))
    return triplets.groupBy("user_id").agg(songs.alias("n_songs")).filter(F.col("n_songs") < min_songs)


def drop_low_play_songs(triplets: DataFrame, min_plays: int = 100) -> DataFrame:
    return lookup_join(triplets, low_play_songs(triplets, min_plays).select("song_id"), "song_id", "left_anti")


def active_subset(
    triplets: DataFrame,
    min_plays: int = 100,
    min_songs: int = 30,
    distinct_songs: bool = False,
    until_stable: bool = False,
) -> DataFrame:
    """Triplets of well-played songs and active users.

    Activity is counted before songs are removed, in a single pass, so a kept user
    may end with fewer than ``min_songs`` songs. With ``until_stable`` passes follow until
    nothing is removed; each is written down.
    """
    if until_stable:
        rows = None
        while rows != (now := triplets.count()):
            rows = now
            triplets = freeze(active_subset(triplets, min_plays, min_songs, distinct_songs))
        return triplets
    idle = low_song_users(triplets, min_songs, distinct_songs).select("user_id")
    return lookup_join(drop_low_play_songs(triplets, min_plays), idle, "user_id", "left_anti")


def normalize_track_id(features: DataFrame, quoted: str = "MSD_TRACKID") -> DataFrame:
    """Replaces a quoted id column by a plain ``track_id``."""
    return features.withColumn("track_id", ids.unquoted(F.col(quoted))).drop(quoted)


def label_features(genres: DataFrame, features: DataFrame) -> DataFrame:
    """``(track_id, genre, *features)`` of the tracks that have a genre.

    The narrow label table is the lookup, so the wide features move only if it is too
    large to broadcast.
    """
    labelled = lookup_join(features, genres.select("track_id", "genre"), "track_id", "inner", stored=True)
    return labelled.select("track_id", "genre", *[c for c in features.columns if c != "track_id"])
