"""Registered music-plays queries: star schema, lookup tables, warehouse questions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import session as S
from ..operators import numbering as N
from ..sources import views as V
from . import analytics as A
from . import lookups as L
from . import star as ST
from . import user_states as U
from .registry import register
from ..sources.views import duckdb_with

MONTH = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
MONTH_SQL = "start_time >= TIMESTAMP '2024-01-01 00:00:00' AND start_time < TIMESTAMP '2024-02-01 00:00:00'"
# Durations are compared as the targets store them.
DURATION_SQL = "DECIMAL(23,5)"

MUSIC_CTES = {
    "plays": ("SELECT * FROM staging_events WHERE page = 'NextSong'", ("staging_events",)),
    "songs_first": ("""
        SELECT song_id, title, artist_id, CAST(year AS INTEGER) AS year, duration FROM (
          SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY song_key) AS rn
          FROM staging_songs_k WHERE song_id IS NOT NULL) WHERE rn = 1""", ("staging_songs_k",)),
    "artists_distinct": ("""
        SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
               artist_latitude AS latitude, artist_longitude AS longitude
        FROM staging_songs WHERE artist_id IS NOT NULL""", ("staging_songs",)),
    "artists_first": ("""
        SELECT artist_id, name, location, latitude, longitude FROM (
          SELECT artist_id, artist_name AS name, artist_location AS location,
                 artist_latitude AS latitude, artist_longitude AS longitude,
                 row_number() OVER (PARTITION BY artist_id ORDER BY song_key) AS rn
          FROM staging_songs_k WHERE artist_id IS NOT NULL) WHERE rn = 1""", ("staging_songs_k",)),
    "songplays_wh": (f"""
        SELECT md5(CAST(e.sessionId AS VARCHAR) || strftime(e.start_time, '%Y-%m-%d %H:%M:%S')) AS songplay_id,
               e.start_time, e.userId AS user_id, e.level, s.song_id, s.artist_id,
               e.sessionId AS session_id, e.location, e.userAgent AS user_agent
        FROM (SELECT epoch_ms((ts // 1000) * 1000) AS start_time, * FROM plays) e
        LEFT JOIN staging_songs s
          ON e.song = s.title AND e.artist = s.artist_name
         AND CAST(e.length AS {DURATION_SQL}) = CAST(s.duration AS {DURATION_SQL})
        WHERE e.sessionId IS NOT NULL""", ("plays", "staging_songs")),
    "csv_rows": ("""
        SELECT * FROM staging_events WHERE artist IS NOT NULL AND artist <> ''""", ("staging_events",)),
}


def duck(sql: str, *views: str) -> str:
    return duckdb_with(sql, *views, extra=MUSIC_CTES)


def _songs(spark, d):
    return V.staging_songs_ordered(spark, d)


def _events(spark, d):
    return V.staging_events(spark, d)


# ---- dimensions -----------------------------------------------------------

@register("songs_dim", duck("""
    SELECT DISTINCT song_id, title, artist_id, CAST(year AS INTEGER) AS year, duration
    FROM staging_songs WHERE song_id IS NOT NULL""", "staging_songs"))
def q_songs_dim(spark, d):
    """Songs, whole-row distinct."""
    return ST.songs_dim(_songs(spark, d), "distinct")


@register("songs_dim_first", duck("SELECT * FROM songs_first", "songs_first"))
def q_songs_dim_first(spark, d):
    """Songs, first row per song_id wins."""
    return ST.songs_dim(_songs(spark, d), "first")


@register("artists_dim_distinct", duck("SELECT * FROM artists_distinct", "artists_distinct"))
def q_artists_dim_distinct(spark, d):
    """Artists, whole-row distinct."""
    return ST.artists_dim(_songs(spark, d), "distinct")


@register("artists_dim_first", duck("SELECT * FROM artists_first", "artists_first"))
def q_artists_dim_first(spark, d):
    """Artists, first row per artist_id wins."""
    return ST.artists_dim(_songs(spark, d), "first")


USER_COLS = "userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level"


@register("users_none", duck(f"SELECT {USER_COLS} FROM plays", "plays"))
def q_users_none(spark, d):
    """Users as read from every play (no dedup)."""
    return ST.users_dim(_events(spark, d), "none")


@register("users_distinct", duck(f"SELECT DISTINCT {USER_COLS} FROM plays WHERE userId IS NOT NULL", "plays"))
def q_users_distinct(spark, d):
    """Users, whole-row distinct (one row per user and level)."""
    return ST.users_dim(_events(spark, d), "distinct")


@register("users_first_last_level", duck("""
    SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level
    FROM (SELECT userId AS user_id, firstName AS first_name, lastName AS last_name, gender,
                 row_number() OVER (PARTITION BY userId ORDER BY ts, event_id) AS rn
          FROM plays WHERE userId IS NOT NULL) f
    JOIN (SELECT userId AS user_id, level,
                 row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS rn
          FROM plays WHERE userId IS NOT NULL) l
      ON f.user_id = l.user_id AND f.rn = 1 AND l.rn = 1""", "plays"))
def q_users_first_last_level(spark, d):
    """First row's names and gender, latest level (upsert of level only)."""
    return ST.users_dim(_events(spark, d), "first_last_level")


@register("users_all_pages", duck("""
    SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level
    FROM (SELECT userId AS user_id, firstName AS first_name, lastName AS last_name, gender,
                 row_number() OVER (PARTITION BY userId ORDER BY ts, event_id) AS rn
          FROM staging_events WHERE userId IS NOT NULL AND userId <> 0) f
    JOIN (SELECT userId AS user_id, level,
                 row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS rn
          FROM staging_events WHERE userId IS NOT NULL AND userId <> 0) l
      ON f.user_id = l.user_id AND f.rn = 1 AND l.rn = 1""", "staging_events"))
def q_users_all_pages(spark, d):
    """Users of every page's events, ids that are null, empty or zero skipped."""
    return ST.users_dim(_events(spark, d), "first_last_level", pages="all")


TIME_PARTS_SQL = "hour(t) AS hour, day(t) AS day, weekofyear(t) AS week, month(t) AS month, year(t) AS year"


@register("time_dim", duck(f"""
    SELECT DISTINCT t AS start_time, {TIME_PARTS_SQL}, dayofweek(t) + 1 AS weekday
    FROM (SELECT epoch_ms(ts) AS t FROM plays)""", "plays"))
def q_time_dim(spark, d):
    """Time parts of every play (ms kept), Sunday=1, one row per instant."""
    ev = ST.plays(_events(spark, d)).select(F.timestamp_millis("ts").alias("start_time"))
    return ST.time_dim(ev, convention="spark")


@register("time_dim_pandas_dup", duck(f"""
    SELECT t AS start_time, {TIME_PARTS_SQL}, isodow(t) - 1 AS weekday
    FROM (SELECT epoch_ms(ts) AS t FROM plays)""", "plays"))
def q_time_dim_pandas_dup(spark, d):
    """One row per play (plain inserts keep duplicates), Monday=0."""
    ev = ST.plays(_events(spark, d)).select(F.timestamp_millis("ts").alias("start_time"))
    return ST.time_dim(ev, convention="pandas", dedup=False)


@register("time_dim_warehouse", duck(f"""
    SELECT DISTINCT t AS start_time, {TIME_PARTS_SQL}, dayofweek(t) AS weekday
    FROM (SELECT start_time AS t FROM songplays_wh)""", "songplays_wh"))
def q_time_dim_warehouse(spark, d):
    """From the warehouse fact (whole seconds), Sunday=0."""
    fact = ST.songplays_warehouse(_events(spark, d), V.staging_songs(spark, d))
    return ST.time_dim(fact, convention="warehouse")


@register("time_text", duck("""
    SELECT epoch_ms(ts) AS start_time,
           strftime(epoch_ms(ts), '%Y-%m-%d %H:%M:%S') AS text_24h,
           strftime(epoch_ms(ts), '%Y-%m-%d %I:%M:%S') AS text_12h
    FROM plays""", "plays"))
def q_time_text(spark, d):
    """Start time as text -- 24-hour, and the reference's 'hh' (12-hour, no marker)."""
    from ..functions.timeparts import start_time_text
    ev = ST.plays(_events(spark, d)).select(F.timestamp_millis("ts").alias("start_time"))
    return ev.select("start_time", start_time_text("start_time").alias("text_24h"),
                     start_time_text("start_time", twelve_hour=True).alias("text_12h"))


# ---- fact -----------------------------------------------------------------

@register("songplays_md5", duck("SELECT * FROM songplays_wh", "songplays_wh"))
def q_songplays_md5(spark, d):
    """Warehouse fact, 3-key left join, md5 key."""
    return ST.songplays_warehouse(_events(spark, d), V.staging_songs(spark, d))


@register("songplays_two_key", duck(f"""
    SELECT epoch_ms(e.ts) AS start_time, e.userId AS user_id, e.level, s.song_id, s.artist_id,
           e.sessionId AS session_id, e.location, e.userAgent AS user_agent,
           year(epoch_ms(e.ts)) AS year, month(epoch_ms(e.ts)) AS month
    FROM plays e LEFT JOIN staging_songs s ON s.title = e.song
      AND CAST(s.duration AS {DURATION_SQL}) = CAST(e.length AS {DURATION_SQL})""",
    "plays", "staging_songs"))
def q_songplays_two_key(spark, d):
    """M4/D3: data-lake fact, left join on title and duration (fan-out kept)."""
    return ST.songplays_lake(_events(spark, d), V.staging_songs(spark, d))


LAKE_FACT_SQL = """
    SELECT epoch_ms(e.ts) AS start_time, e.userId AS user_id, e.level, s.song_id, s.artist_id,
           e.sessionId AS session_id, e.location, e.userAgent AS user_agent
    FROM plays e LEFT JOIN staging_songs s ON s.title = e.song
      AND CAST(s.duration AS DECIMAL(23,5)) = CAST(e.length AS DECIMAL(23,5))"""
LAKE_ORDER = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]


@register("songplays_with_id", duck(f"""
    SELECT row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in LAKE_ORDER)}) AS songplay_id, *
    FROM ({LAKE_FACT_SQL})""", "plays", "staging_songs"))
def q_songplays_with_id(spark, d):
    """Data-lake fact with dense ids in the declared order, over two loads; the
    second continues after the largest id of the first."""
    path = S.shared_dir(spark, "numbered-plays")
    fact = ST.songplays_lake(_events(spark, d), V.staging_songs(spark, d)).select(*LAKE_ORDER)
    schema = StructType([StructField("songplay_id", LongType(), True), *fact.schema.fields])
    cut = F.to_timestamp(F.lit("2024-01-16 00:00:00"))
    for part in (fact.filter(F.col("start_time") < cut), fact.filter((F.col("start_time") >= cut) | F.col("start_time").isNull())):
        N.append_numbered(spark, part, path, LAKE_ORDER, "songplay_id", schema)
    return spark.read.schema(schema).parquet(path)


@register("songplays_id_unique", duck(f"""
    SELECT count(*) AS rows, count(*) AS distinct_ids
    FROM plays e LEFT JOIN staging_songs s ON s.title = e.song
      AND CAST(s.duration AS {DURATION_SQL}) = CAST(e.length AS {DURATION_SQL})""", "plays", "staging_songs"))
def q_songplays_id_unique(spark, d):
    """The row ids of the data-lake fact are unique (their values are not fixed)."""
    fact = ST.songplays_lake(_events(spark, d), V.staging_songs(spark, d), with_id=True)
    return fact.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("songplay_id").alias("distinct_ids"))


@register("plays_by_user_level", duck("""
    SELECT u.level AS user_level, f.level AS play_level, count(*) AS plays
    FROM songplays_wh f JOIN (
      SELECT userId, level, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS rn
      FROM plays WHERE userId IS NOT NULL) u ON u.userId = f.user_id AND u.rn = 1
    GROUP BY u.level, f.level""", "songplays_wh", "plays"))
def q_plays_by_user_level(spark, d):
    """The fact joined with the users dimension, which every node holds in the
    reference; Spark sends it to every task when its size in bytes allows."""
    ev = _events(spark, d)
    users = ST.users_dim(ev, "first_last_level").select("user_id", F.col("level").alias("user_level"))
    fact = ST.songplays_warehouse(ev, V.staging_songs(spark, d)).select("user_id", F.col("level").alias("play_level"))
    return fact.join(users, "user_id").groupBy("user_level", "play_level").agg(F.count(F.lit(1)).alias("plays"))


def _lookup_sql(key: str) -> str:
    return f"""
    SELECT start_time, user_id, level, song_id, artist_id, session_id, location, user_agent FROM (
      SELECT e.*, d.song_id, d.artist_id,
             row_number() OVER (PARTITION BY {key} ORDER BY e.ts, e.event_id) AS rn
      FROM (SELECT epoch_ms(ts) AS start_time, userId AS user_id, level, song, artist, length,
                   sessionId AS session_id, location, userAgent AS user_agent, ts, event_id
            FROM plays) e
      LEFT JOIN (SELECT title, name, duration, song_id, artist_id FROM (
                   SELECT s.title, a.name, CAST(s.duration AS {DURATION_SQL}) AS duration, s.song_id, s.artist_id,
                          row_number() OVER (PARTITION BY s.title, a.name, CAST(s.duration AS {DURATION_SQL})
                                             ORDER BY s.song_id, s.artist_id) AS rk
                   FROM songs_first s JOIN artists_first a ON s.artist_id = a.artist_id) WHERE rk = 1) d
        ON e.song = d.title AND e.artist = d.name AND CAST(e.length AS {DURATION_SQL}) = d.duration)
    WHERE rn = 1"""


@register("songplays_lookup", duck(_lookup_sql("e.session_id, e.start_time, e.user_id"),
                                   "plays", "songs_first", "artists_first"))
def q_songplays_lookup(spark, d):
    """Per-play single-row song lookup; first play per (session, time, user)."""
    songs = _songs(spark, d)
    return ST.songplays_lookup(_events(spark, d), ST.songs_dim(songs, "first"), ST.artists_dim(songs, "first"))


@register("songplays_unique_start", duck(_lookup_sql("e.start_time"),
                                         "plays", "songs_first", "artists_first"))
def q_songplays_unique_start(spark, d):
    """As above but unique on start_time alone (the reference's key)."""
    songs = _songs(spark, d)
    return ST.songplays_lookup(_events(spark, d), ST.songs_dim(songs, "first"),
                               ST.artists_dim(songs, "first"), dedup_key=("start_time",))


# ---- query-shaped lookup tables --------------------------------------------

@register("session_item_table", duck("""
    SELECT session_id, item_in_session, artist, song, length FROM (
      SELECT CAST(sessionId AS BIGINT) AS session_id, CAST(itemInSession AS INTEGER) AS item_in_session,
             artist, song, CAST(length AS FLOAT) AS length,
             row_number() OVER (PARTITION BY sessionId, itemInSession ORDER BY ts DESC, event_id DESC) AS rn
      FROM csv_rows) WHERE rn = 1""", "csv_rows"))
def q_session_item_table(spark, d):
    """(session, item) -> artist, song, length; last write wins."""
    return L.session_items(_events(spark, d))


# Point-lookup keys come from the data: the key with most events, ties to the smallest.

SESSION_ITEM_KEY_SQL = """SELECT sessionId, itemInSession FROM csv_rows GROUP BY sessionId, itemInSession
    ORDER BY count(*) DESC, sessionId, itemInSession LIMIT 1"""


def top_key(events, *keys):
    """The key values that most event rows hold, as plain values (one row)."""
    n = L.event_rows(events).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = n.orderBy(F.col("n").desc(), *keys).limit(1).first()
    return tuple(row[k] for k in keys) if row else (None,) * len(keys)


@register("session_item", duck(f"""
    SELECT artist, song, length FROM (
      SELECT artist, song, CAST(length AS FLOAT) AS length,
             row_number() OVER (PARTITION BY sessionId, itemInSession ORDER BY ts DESC, event_id DESC) AS rn
      FROM csv_rows WHERE (sessionId, itemInSession) IN ({SESSION_ITEM_KEY_SQL}))
    WHERE rn = 1""", "csv_rows"))
def q_session_item(spark, d):
    """What was played at one (session, item)."""
    ev = _events(spark, d)
    return L.session_item_lookup(L.session_items(ev), *top_key(ev, "sessionId", "itemInSession"))


USER_SESSION_SQL = """
    SELECT user_id, session_id, item_in_session, artist, song, "user" FROM (
      SELECT CAST(userId AS BIGINT) AS user_id, CAST(sessionId AS BIGINT) AS session_id,
             CAST(itemInSession AS INTEGER) AS item_in_session, artist, song,
             firstName || ' ' || lastName AS "user",
             row_number() OVER (PARTITION BY userId, sessionId, itemInSession
                                ORDER BY ts DESC, event_id DESC) AS rn
      FROM csv_rows) WHERE rn = 1"""


@register("user_session_table", duck(USER_SESSION_SQL, "csv_rows"))
def q_user_session_table(spark, d):
    """(user, session, item) -> artist, song, user name; last write wins."""
    return L.user_sessions(_events(spark, d))


@register("user_session", duck(f"""
    SELECT item_in_session, artist, song, "user" FROM ({USER_SESSION_SQL})
    WHERE (user_id, session_id) IN (SELECT userId, sessionId FROM csv_rows GROUP BY userId, sessionId
                                    ORDER BY count(*) DESC, userId, sessionId LIMIT 1)
    ORDER BY item_in_session""", "csv_rows"))
def q_user_session(spark, d):
    """One user's session in item order."""
    ev = _events(spark, d)
    return L.user_session_lookup(L.user_sessions(ev), *top_key(ev, "userId", "sessionId"))


@register("song_listeners_table", duck("""
    SELECT DISTINCT song, firstName || ' ' || lastName AS "user" FROM csv_rows""", "csv_rows"))
def q_song_listeners_table(spark, d):
    """M5: (song, user) pairs."""
    return L.song_listeners(_events(spark, d))


@register("song_listeners", duck(f"""
    SELECT DISTINCT firstName || ' ' || lastName AS "user" FROM csv_rows
    WHERE song IN (SELECT song FROM csv_rows GROUP BY song ORDER BY count(*) DESC, song LIMIT 1)""", "csv_rows"))
def q_song_listeners(spark, d):
    """Everyone who played one song."""
    ev = _events(spark, d)
    return L.song_listener_lookup(L.song_listeners(ev), *top_key(ev, "song"))


# ---- warehouse questions ---------------------------------------------------

def _fact(spark, d):
    return ST.songplays_warehouse(_events(spark, d), V.staging_songs(spark, d))


def _artists(spark, d):
    return ST.artists_dim(_songs(spark, d), "distinct")


@register("monthly_unique_users", duck(f"""
    SELECT count(DISTINCT user_id) AS unique_users FROM songplays_wh WHERE {MONTH_SQL}""", "songplays_wh"))
def q_monthly_unique_users(spark, d):
    """Distinct users in one month."""
    return A.unique_users(_fact(spark, d), *MONTH)


@register("monthly_users_from_states", duck(f"""
    SELECT CAST(date_trunc('month', start_time) AS DATE) AS month, count(DISTINCT user_id) AS unique_users
    FROM songplays_wh WHERE start_time IS NOT NULL GROUP BY 1 HAVING count(user_id) > 0""", "songplays_wh"))
def q_monthly_users_from_states(spark, d):
    """E5/M6: distinct users of every month from daily bitmaps that two loads stored;
    the fact is not read for the answer."""
    path = S.shared_dir(spark, "user-states")
    fact = _fact(spark, d).select("start_time", "user_id")
    cut = F.to_timestamp(F.lit("2024-01-16 12:00:00"))  # the day of the cut gets states from both loads
    U.add_days(fact.filter(F.col("start_time") < cut), path)
    U.add_days(fact.filter(F.col("start_time") >= cut), path)
    return U.unique_users_by_month(spark, path)


@register("top_locations", duck(f"""
    SELECT location, count(*) AS streams FROM songplays_wh WHERE {MONTH_SQL}
    GROUP BY location ORDER BY streams DESC, location ASC NULLS LAST LIMIT 5""", "songplays_wh"))
def q_top_locations(spark, d):
    """Five most played locations."""
    return A.top_locations(_fact(spark, d), *MONTH)


@register("top_location_artists", duck(f"""
    SELECT sp.location, a.name, count(*) AS streams
    FROM songplays_wh sp JOIN artists_distinct a ON a.artist_id = sp.artist_id
    WHERE {MONTH_SQL}
    GROUP BY sp.location, a.name
    ORDER BY streams DESC, sp.location ASC NULLS LAST, a.name ASC NULLS LAST LIMIT 5""",
    "songplays_wh", "artists_distinct"))
def q_top_location_artists(spark, d):
    """Top five (location, artist) pairs as the warehouse query is written."""
    return A.top_location_artists(_fact(spark, d), _artists(spark, d), *MONTH)


@register("top_artist_per_location", duck(f"""
    SELECT location, name, streams FROM (
      SELECT s.*, row_number() OVER (PARTITION BY s.location
                                     ORDER BY s.streams DESC, s.name ASC NULLS LAST) AS rn
      FROM (SELECT sp.location, a.name, count(*) AS streams
            FROM songplays_wh sp JOIN artists_distinct a ON a.artist_id = sp.artist_id
            WHERE {MONTH_SQL} GROUP BY sp.location, a.name) s
      WHERE s.location IN (SELECT location FROM songplays_wh WHERE {MONTH_SQL} GROUP BY location
                           ORDER BY count(*) DESC, location ASC NULLS LAST LIMIT 5))
    WHERE rn = 1""", "songplays_wh", "artists_distinct"))
def q_top_artist_per_location(spark, d):
    """The most played artist in each of the five top locations."""
    return A.top_artist_per_location(_fact(spark, d), _artists(spark, d), *MONTH)
