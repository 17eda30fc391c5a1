"""Cutting identifiers out of fixed-width text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the input layout: 1-based positions and the id width.
ID_WIDTH = 18
SONG_AT = 9
TRACK_AT = 28
QUOTED_AT = 2


def mismatch_song(line: Column) -> Column:
    return F.substring(line, SONG_AT, ID_WIDTH)


def mismatch_track(line: Column) -> Column:
    return F.substring(line, TRACK_AT, ID_WIDTH)


def unquoted(quoted_id: Column) -> Column:
    """The id inside a one-character wrapping quote."""
    return F.substring(quoted_id, QUOTED_AT, ID_WIDTH)
