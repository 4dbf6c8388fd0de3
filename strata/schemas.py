"""Explicit schemas of the reference-shaped inputs and targets."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType,
                               ShortType, StringType, StructField, StructType, TimestampType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SONG_JSON = _s(("num_songs", IntegerType()), ("artist_id", StringType()), ("artist_name", StringType()),
               ("artist_latitude", DoubleType()), ("artist_longitude", DoubleType()),
               ("artist_location", StringType()), ("song_id", StringType()), ("title", StringType()),
               ("duration", DoubleType()), ("year", IntegerType()))

EVENT_JSON = _s(("event_id", LongType()), ("artist", StringType()), ("auth", StringType()),
                ("firstName", StringType()), ("gender", StringType()), ("itemInSession", IntegerType()),
                ("lastName", StringType()), ("length", DoubleType()), ("level", StringType()),
                ("location", StringType()), ("method", StringType()), ("page", StringType()),
                ("registration", LongType()), ("sessionId", LongType()), ("song", StringType()),
                ("status", IntegerType()), ("ts", LongType()), ("userAgent", StringType()),
                ("userId", LongType()))

# The event CSV written for the query tables (11 used columns + arrival order).
EVENT_CSV = _s(("artist", StringType()), ("firstName", StringType()), ("gender", StringType()),
               ("itemInSession", IntegerType()), ("lastName", StringType()), ("length", DoubleType()),
               ("level", StringType()), ("location", StringType()), ("sessionId", LongType()),
               ("song", StringType()), ("userId", LongType()), ("ts", LongType()), ("event_id", LongType()))

# The event CSV as it arrives: 17 columns, of which 11 are used.
EVENT_CSV_ALL = _s(("artist", StringType()), ("auth", StringType()), ("firstName", StringType()), ("gender", StringType()),
                   ("itemInSession", IntegerType()), ("lastName", StringType()), ("length", DoubleType()), ("level", StringType()),
                   ("location", StringType()), ("method", StringType()), ("page", StringType()), ("registration", LongType()),
                   ("sessionId", LongType()), ("song", StringType()), ("status", IntegerType()), ("ts", LongType()),
                   ("userId", LongType()))
EVENT_CSV_USED = ["artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location", "sessionId",
                  "song", "userId"]

CHAT_CSV = _s(("match_id", LongType()), ("key", StringType()), ("slot", IntegerType()),
              ("time", LongType()), ("unit", StringType()))

MATCH_CSV = _s(("match_id", LongType()), ("start_time", LongType()), ("duration", LongType()),
               ("tower_status_radiant", LongType()), ("tower_status_dire", LongType()),
               ("barracks_status_dire", LongType()), ("barracks_status_radiant", LongType()),
               ("first_blood_time", LongType()), ("game_mode", IntegerType()), ("radiant_win", BooleanType()),
               ("negative_votes", IntegerType()), ("positive_votes", LongType()), ("cluster", LongType()))

REGION_CSV = _s(("cluster", IntegerType()), ("region", StringType()))

# Targets.
CHAT = _s(("match_id", LongType()), ("chat", StringType()), ("slot", ShortType()),
          ("time_in_seconds", IntegerType()), ("player_name", StringType()),
          ("date_processed", TimestampType()))

MATCH = _s(("match_id", LongType()), ("start_time", TimestampType()), ("match_date", DateType()),
           ("duration_in_seconds", IntegerType()), ("tower_status_radiant", IntegerType()),
           ("tower_status_dire", IntegerType()), ("barracks_status_dire", IntegerType()),
           ("barracks_status_radiant", IntegerType()), ("first_blood_time", IntegerType()),
           ("game_mode", ShortType()), ("radiant_win", BooleanType()), ("negative_votes", ShortType()),
           ("positive_votes", ShortType()), ("cluster_id", IntegerType()), ("date_processed", TimestampType()))

REGION = _s(("cluster_id", IntegerType()), ("region", StringType()), ("date_processed", TimestampType()))

MATCH_SUMMARY = _s(("match_id", LongType()), ("match_date", DateType()), ("toxic", BooleanType()),
                   ("toxic_count", IntegerType()), ("toxic_player_count", IntegerType()),
                   ("region", StringType()))

SONGS = _s(("song_id", StringType()), ("title", StringType()), ("artist_id", StringType()),
           ("year", IntegerType()), ("duration", DoubleType()))

ARTISTS = _s(("artist_id", StringType()), ("name", StringType()), ("location", StringType()),
             ("latitude", DoubleType()), ("longitude", DoubleType()))

USERS = _s(("user_id", LongType()), ("first_name", StringType()), ("last_name", StringType()),
           ("gender", StringType()), ("level", StringType()))

TIME = _s(("start_time", TimestampType()), ("hour", IntegerType()), ("day", IntegerType()),
          ("week", IntegerType()), ("month", IntegerType()), ("year", IntegerType()),
          ("weekday", IntegerType()))

SONGPLAYS = _s(("songplay_id", StringType()), ("start_time", TimestampType()), ("user_id", LongType()),
               ("level", StringType()), ("song_id", StringType()), ("artist_id", StringType()),
               ("session_id", LongType()), ("location", StringType()), ("user_agent", StringType()))

TABLES = {"songs": SONGS, "artists": ARTISTS, "users": USERS, "time": TIME, "songplays": SONGPLAYS,
          "chat_data": CHAT, "match_data": MATCH, "cluster_regions_data": REGION,
          "match_summary_data": MATCH_SUMMARY}
