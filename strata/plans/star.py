"""Star schema from song metadata and app event logs: songs, artists, users,
time dimensions and the songplays fact, with each build's semantics an option.

Dedup policies (the reference builds the same schema three ways):
  songs / artists: "distinct" (whole-row distinct), "first" (first row per key
                   wins, insert-if-absent), "none" (as read)
  users:           "none", "distinct", "first_last_level" (first row's names and
                   gender, last row's level: an upsert that updates level only)
  songplays:       "warehouse" (3-key left join, whole-second time, md5 key),
                   "lake" (2-key left join on title + duration, ms time),
                   "lookup" (one song per (title, artist name, duration), never
                   fans out; first play per dedup key wins)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.keys import md5_key
from ..functions.timeparts import epoch_ms_to_ts, epoch_ms_to_ts_seconds, time_parts
from ..operators.dedup import first_by_key, first_row_last_columns
from ..operators.joins import lookup_join

NEXT_SONG = "NextSong"


def plays(events: DataFrame) -> DataFrame:
    """Events that are song plays (page = 'NextSong')."""
    return events.filter(F.col("page") == NEXT_SONG)


def songs_dim(songs: DataFrame, policy: str = "distinct", order_col: str = "song_key") -> DataFrame:
    cols = [F.col("song_id"), F.col("title"), F.col("artist_id"), F.col("year").cast("int").alias("year"),
            F.col("duration")]
    if policy == "none":
        return songs.select(*cols)
    if policy == "distinct":
        return songs.filter(F.col("song_id").isNotNull()).select(*cols).distinct()
    if policy == "first":
        base = songs.filter(F.col("song_id").isNotNull()).select(*cols, F.col(order_col).alias("__o"))
        return first_by_key(base, ["song_id"], ["__o"]).drop("__o")
    raise ValueError(f"unknown songs policy {policy!r}")


def artists_dim(songs: DataFrame, policy: str = "distinct", order_col: str = "song_key") -> DataFrame:
    cols = [F.col("artist_id"), F.col("artist_name").alias("name"), F.col("artist_location").alias("location"),
            F.col("artist_latitude").alias("latitude"), F.col("artist_longitude").alias("longitude")]
    if policy == "none":
        return songs.select(*cols)
    if policy == "distinct":
        return songs.filter(F.col("artist_id").isNotNull()).select(*cols).distinct()
    if policy == "first":
        base = songs.filter(F.col("artist_id").isNotNull()).select(*cols, F.col(order_col).alias("__o"))
        return first_by_key(base, ["artist_id"], ["__o"]).drop("__o")
    raise ValueError(f"unknown artists policy {policy!r}")


def _truthy(events: DataFrame, c: str) -> Column:
    """Neither null nor empty nor zero."""
    empty = "" if isinstance(events.schema[c].dataType, StringType) else 0
    return F.col(c).isNotNull() & (F.col(c) != F.lit(empty))


def users_dim(events: DataFrame, policy: str = "distinct",
              order_by: Sequence[str] = ("ts", "event_id"), pages: str = "plays") -> DataFrame:
    """``pages``: "plays" takes users from song plays; "all" from the events of
    every page, without those whose id is null, empty or zero (under any policy)."""
    if pages not in ("plays", "all"):
        raise ValueError(f"unknown pages {pages!r}")
    p = plays(events) if pages == "plays" else events.filter(_truthy(events, "userId"))
    cols = [F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
            F.col("lastName").alias("last_name"), F.col("gender"), F.col("level")]
    if policy == "none":
        return p.select(*cols)
    if policy == "distinct":
        return p.filter(F.col("userId").isNotNull()).select(*cols).distinct()
    if policy == "first_last_level":
        base = p.filter(F.col("userId").isNotNull()).select(*cols, *[F.col(c).alias(f"__o{i}")
                                                                    for i, c in enumerate(order_by)])
        o = [f"__o{i}" for i in range(len(order_by))]
        return first_row_last_columns(base, ["user_id"], o, ["level"]).drop(*o)
    raise ValueError(f"unknown users policy {policy!r}")


def time_dim(start_times: DataFrame, ts_col: str = "start_time", convention: str = "spark",
             dedup: bool = True) -> DataFrame:
    """start_time, hour, day, week (ISO), month, year, weekday (numbering per convention).
    ``dedup`` keeps one row per start_time; off keeps one row per play (plain inserts)."""
    out = start_times.select(F.col(ts_col).alias("start_time"), *time_parts(ts_col, convention))
    return out.distinct() if dedup else out


DURATION_PLACES = 5


def _scaled(c: str, precision: int):
    """Duration as compared: a decimal of ``precision`` places, as the targets
    store it (precision 0 reproduces a numeric(18,0) column, whole seconds)."""
    return F.col(c).cast(f"decimal({18 + precision},{precision})")


def songplays_warehouse(events: DataFrame, songs: DataFrame, match_precision: int = DURATION_PLACES) -> DataFrame:
    """Warehouse build: seconds-precision start time, md5(session || time) key,
    left join on (title, artist name, duration), plays with a session id only.
    ``match_precision=0`` compares durations rounded to whole seconds (fan-out
    possible when two songs of one artist and title round alike)."""
    ev = plays(events).filter(F.col("sessionId").isNotNull()) \
        .withColumn("start_time", epoch_ms_to_ts_seconds("ts"))
    s = songs.select(F.col("title").alias("__t"), F.col("artist_name").alias("__a"),
                     F.col("duration").alias("__d"), "song_id", "artist_id")
    j = ev.join(s, (F.col("song") == F.col("__t")) & (F.col("artist") == F.col("__a"))
                & (_scaled("length", match_precision) == _scaled("__d", match_precision)), "left")
    return j.select(
        md5_key("sessionId", "start_time").alias("songplay_id"),
        "start_time",
        F.col("userId").alias("user_id"), "level", "song_id", "artist_id",
        F.col("sessionId").alias("session_id"), "location", F.col("userAgent").alias("user_agent"),
    )


def songplays_lake(events: DataFrame, songs: DataFrame, with_id: bool = False) -> DataFrame:
    """Data-lake build: ms-precision time, left join on title and duration only
    (a title+duration shared by two artists fans out), year/month for layout."""
    ev = plays(events).withColumn("start_time", epoch_ms_to_ts("ts"))
    s = songs.select(F.col("title").alias("__t"), F.col("duration").alias("__d"), "song_id", "artist_id")
    j = ev.join(s, (F.col("song") == F.col("__t"))
                & (_scaled("length", DURATION_PLACES) == _scaled("__d", DURATION_PLACES)), "left")
    cols = [
        "start_time", F.col("userId").alias("user_id"), "level", "song_id", "artist_id",
        F.col("sessionId").alias("session_id"), "location", F.col("userAgent").alias("user_agent"),
        F.year("start_time").alias("year"), F.month("start_time").alias("month"),
    ]
    if with_id:
        cols.insert(0, F.monotonically_increasing_id().alias("songplay_id"))
    return j.select(*cols)


def songplays_lookup(events: DataFrame, songs: DataFrame, artists: DataFrame,
                     dedup_key: Sequence[str] = ("session_id", "start_time", "user_id"),
                     order_by: Sequence[str] = ("__ts", "__eid")) -> DataFrame:
    """Row-lookup build: per play, the song whose title, artist name and duration
    match (songs joined to artists; the smallest song_id if several), else nulls.
    Then the first play per ``dedup_key`` wins (the reference keys on start_time
    alone, which drops concurrent plays of other users -- pass ("start_time",)).
    """
    ev = plays(events).select(
        epoch_ms_to_ts("ts").alias("start_time"), F.col("userId").alias("user_id"), "level",
        "song", "artist", _scaled("length", DURATION_PLACES).alias("length"), F.col("sessionId").alias("session_id"), "location",
        F.col("userAgent").alias("user_agent"), F.col("ts").alias("__ts"), F.col("event_id").alias("__eid"))
    dim = songs.select("song_id", "title", "artist_id", _scaled("duration", DURATION_PLACES).alias("duration")) \
        .join(artists.select("artist_id", "name"), "artist_id")
    j = lookup_join(ev, dim, ["song", "artist", "length"], ["title", "name", "duration"],
                    ["song_id", "artist_id"], ["song_id", "artist_id"])
    out = j.select("start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location",
                   "user_agent", "__ts", "__eid")
    return first_by_key(out, list(dedup_key), list(order_by)).drop("__ts", "__eid")
