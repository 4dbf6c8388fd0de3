"""The driver's TPC-H-ish test tables re-shaped into the reference's inputs.

Each view is built twice: as a Spark DataFrame (used by the jobs) and as
DuckDB SQL text (used only by the oracle).  The two are written
independently from the same rule; see FIXTURES.md section 4.  No view leaves
out rows of its tables.

  staging_songs   part x supplier x nation  (song JSON shape)
  staging_events  events x nation x songs   (event-log JSON shape)
  region_raw      nation x region           (cluster_regions.csv shape)
  match_raw       the customers of orders   (match.csv shape)
  chat_raw        conversations             (chat.csv shape)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import modified

# Fixed values of the mapping (FIXTURES.md section 4).
SONG_STEP = 20          # an event of user u with props.k plays song u * 20 + k (a third of the keys have no song)
MATCH_EPOCH_S = 1446750112
MATCH_STEP_S = 600
CLUSTERS = 30           # cluster_id = match_id % 30; ids >= 25 have no region
NATIONS = 25            # TPC-H nation is a fixed 25-row table


_SCHEMAS: dict[tuple[str, int], StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read under its schema.

    A parquet read without a schema runs a footer-reading job to infer one;
    the schema of a path is resolved once per modification time and then given
    explicitly, so a table rewritten with another schema is read under its own."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (path, modified(spark, path))
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _songs_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    # A song's artist is the supplier with the smallest key that delivers the part.
    maker = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s_suppkey"))
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    artists = sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    songs = part.join(maker, F.col("p_partkey") == F.col("l_partkey"), "left").join(artists, "s_suppkey", "left")
    return songs.select(
        F.col("p_partkey").alias("song_key"),
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("artist_id"),
        F.col("s_name").alias("artist_name"),
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey").cast("double") * 3.5 - 40.0)
         .alias("artist_latitude"),
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey").cast("double") * 7.25 - 100.0)
         .alias("artist_longitude"),
        F.col("n_name").alias("artist_location"),
        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("duration"),
        (F.lit(1990) + F.col("p_size") % 30).alias("year"),
    )


SONG_COLUMNS = ["num_songs", "artist_id", "artist_name", "artist_latitude", "artist_longitude",
                "artist_location", "song_id", "title", "duration", "year"]


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song metadata, one row per song (p_partkey)."""
    return _songs_keyed(spark, sf_dir).select(*SONG_COLUMNS)


def staging_songs_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same, plus ``song_key`` as the arrival order (file order of song files)."""
    return _songs_keyed(spark, sf_dir)


EVENT_COLUMNS = ["event_id", "artist", "auth", "firstName", "gender", "itemInSession", "lastName",
                 "length", "level", "location", "method", "page", "registration", "sessionId",
                 "song", "status", "ts", "userAgent", "userId"]


def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App event log in the reference's JSON shape; ``event_id`` is the arrival order.

    itemInSession is the hour of the event, so a session can hold an item twice
    (a later write of the same key must win)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    ev = ev.withColumn("k", F.get_json_object("props", "$.k").cast("int")) \
        .withColumn("played", F.col("user_id") * SONG_STEP + F.col("k"))
    songs = _songs_keyed(spark, sf_dir).select(
        "song_key", F.col("title").alias("__title"), F.col("artist_name").alias("__artist"), F.col("duration").alias("__duration"))
    ev = ev.join(songs, F.col("played") == F.col("song_key"), "left")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("__loc"))
    ev = ev.join(nation, (F.col("user_id") % NATIONS) == F.col("n_nationkey"), "left")
    is_known = F.col("song_key").isNotNull()
    return ev.select(
        "event_id",
        F.when(is_known, F.col("__artist")).otherwise(F.lit("")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.concat(F.lit("F"), (F.col("user_id") % 40).cast("string")).alias("firstName"),
        F.when(F.col("user_id") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.hour("ts").alias("itemInSession"),
        F.concat(F.lit("L"), (F.col("user_id") % 50).cast("string")).alias("lastName"),
        F.when(is_known, F.col("__duration")).alias("length"),
        F.when(F.col("value") > 100, F.lit("paid")).otherwise(F.lit("free")).alias("level"),
        F.col("__loc").alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("NextSong"))
         .otherwise(F.col("event_type")).alias("page"),
        (F.lit(1_500_000_000_000) + F.col("user_id") * 1000).alias("registration"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("sessionId"),
        F.when(is_known, F.col("__title"))
         .otherwise(F.concat(F.lit("unknown "), F.col("played").cast("string"))).alias("song"),
        F.lit(200).alias("status"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.concat(F.lit("agent/"), (F.col("user_id") % 7).cast("string")).alias("userAgent"),
        F.col("user_id").alias("userId"),
    ).select(*EVENT_COLUMNS)


def region_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cluster_regions.csv shape: cluster, region."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_nationkey").alias("cluster"), F.col("r_name").alias("region"))


def match_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match.csv shape, one row per customer with an order.

    The ids are even, so every other conversation has no match, and most
    matches have no conversation."""
    ids = read_table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("match_id")).distinct()
    m = F.col("match_id")
    return ids.select(
        m,
        (F.lit(MATCH_EPOCH_S) + m * MATCH_STEP_S).alias("start_time"),
        (F.lit(1500) + (m * 37) % 2400).alias("duration"),
        ((m * 13) % 2048).alias("tower_status_radiant"),
        ((m * 29) % 2048).alias("tower_status_dire"),
        ((m * 7) % 64).alias("barracks_status_dire"),
        ((m * 11) % 64).alias("barracks_status_radiant"),
        ((m * 17) % 300).alias("first_blood_time"),
        F.lit(22).alias("game_mode"),
        (m % 4 == 0).alias("radiant_win"),
        F.lit(0).alias("negative_votes"),
        (m % 3).alias("positive_votes"),
        (m % CLUSTERS).alias("cluster"),
    )


def chat_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chat.csv shape: every line; a system line has no player."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(
        F.col("conv_id").alias("match_id"),
        F.col("text").alias("key"),
        (F.col("turn") % 10).alias("slot"),
        (F.col("turn") * 30).alias("time"),
        F.when(F.col("role") != "system", F.col("role")).alias("unit"),
    )


# ---------------------------------------------------------------------------
# DuckDB text of the same views (oracle side only).

DUCKDB_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "staging_songs_k": ("""
        SELECT p.p_partkey AS song_key, 1 AS num_songs,
               'A' || CAST(s.s_suppkey AS VARCHAR) AS artist_id, s.s_name AS artist_name,
               CASE WHEN s.s_suppkey % 4 <> 0 THEN CAST(s.s_nationkey AS DOUBLE) * 3.5 - 40.0 END AS artist_latitude,
               CASE WHEN s.s_suppkey % 4 <> 0 THEN CAST(s.s_nationkey AS DOUBLE) * 7.25 - 100.0 END AS artist_longitude,
               n.n_name AS artist_location,
               'S' || CAST(p.p_partkey AS VARCHAR) AS song_id, p.p_name AS title,
               p.p_retailprice AS duration, 1990 + p.p_size % 30 AS year
        FROM part p
        LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS maker FROM lineitem GROUP BY l_partkey) l ON l.l_partkey = p.p_partkey
        LEFT JOIN supplier s ON s.s_suppkey = l.maker
        LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""", ()),
    "staging_songs": ("""
        SELECT num_songs, artist_id, artist_name, artist_latitude, artist_longitude,
               artist_location, song_id, title, duration, year
        FROM staging_songs_k""", ("staging_songs_k",)),
    "staging_events": ("""
        SELECT e.event_id,
               CASE WHEN s.song_key IS NOT NULL THEN s.artist_name ELSE '' END AS artist,
               'Logged In' AS auth,
               'F' || CAST(e.user_id % 40 AS VARCHAR) AS firstName,
               CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CAST(hour(e.ts) AS INTEGER) AS itemInSession,
               'L' || CAST(e.user_id % 50 AS VARCHAR) AS lastName,
               s.duration AS length,
               CASE WHEN e.value > 100 THEN 'paid' ELSE 'free' END AS level,
               n.n_name AS location,
               'PUT' AS method,
               CASE WHEN e.event_type IN ('view', 'click') THEN 'NextSong' ELSE e.event_type END AS page,
               1500000000000 + e.user_id * 1000 AS registration,
               e.user_id * 100 + day(e.ts) AS sessionId,
               CASE WHEN s.song_key IS NOT NULL THEN s.title ELSE 'unknown ' || CAST(e.played AS VARCHAR) END AS song,
               200 AS status,
               epoch_us(e.ts) // 1000 AS ts,
               'agent/' || CAST(e.user_id % 7 AS VARCHAR) AS userAgent,
               e.user_id AS userId
        FROM (SELECT *, user_id * 20 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS played FROM events) e
        LEFT JOIN staging_songs_k s ON s.song_key = e.played
        LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25""", ("staging_songs_k",)),
    "region_raw": ("""
        SELECT n.n_nationkey AS cluster, r.r_name AS region
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""", ()),
    "match_raw": ("""
        SELECT m AS match_id,
               1446750112 + m * 600 AS start_time,
               1500 + (m * 37) % 2400 AS duration,
               (m * 13) % 2048 AS tower_status_radiant,
               (m * 29) % 2048 AS tower_status_dire,
               (m * 7) % 64 AS barracks_status_dire,
               (m * 11) % 64 AS barracks_status_radiant,
               (m * 17) % 300 AS first_blood_time,
               22 AS game_mode,
               m % 4 = 0 AS radiant_win,
               0 AS negative_votes,
               m % 3 AS positive_votes,
               m % 30 AS cluster
        FROM (SELECT DISTINCT 2 * o_custkey AS m FROM orders)""", ()),
    "chat_raw": ("""
        SELECT conv_id AS match_id, text AS key, turn % 10 AS slot, turn * 30 AS time,
               CASE WHEN role <> 'system' THEN role END AS unit
        FROM conversations""", ()),
}


def duckdb_with(sql: str, *views: str, extra: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> str:
    """Prefix ``sql`` with a WITH clause defining ``views`` and their dependencies."""
    defs = dict(DUCKDB_VIEWS)
    if extra:
        defs.update(extra)
    order: list[str] = []

    def visit(v: str) -> None:
        if v in order:
            return
        for d in defs[v][1]:
            visit(d)
        order.append(v)

    for v in views:
        visit(v)
    if not order:
        return sql
    ctes = ",\n".join(f"{v} AS ({defs[v][0]}\n)" for v in order)
    return f"WITH {ctes}\n{sql}"
