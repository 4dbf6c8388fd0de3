"""Registered queries over stored tables: bucketed upserts, compaction, the fact by
day, lookups through Bloom filters, and word lists that are tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as SC
from .. import session as S
from .. import sinks as K
from ..functions.text import TOXIC_WORDS
from ..operators import word_list as W
from ..sources import views as V
from . import analytics as A
from . import lookups as L
from . import star as ST
from . import stored_fact as SF
from . import top_states as TS
from .queries_io import _split
from .queries_music import MONTH, _artists, _fact, duck, top_key
from .registry import ORACLE, _hits_sql, register

IN_MONTH = "year = 2024 AND month = 1"


@register("upsert_users_buckets", ORACLE["upsert_users_batches"])
def q_upsert_users_buckets(spark, d):
    """Two time batches upserted into users kept by hash buckets of the id, the second
    batch twice; each rewrites only the buckets that it has users in."""
    p = ST.plays(V.staging_events(spark, d)).filter(F.col("userId").isNotNull())
    rows = p.select(F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
                    F.col("lastName").alias("last_name"), "gender", "level", "ts", "event_id")
    users = K.KeyedTable(S.shared_dir(spark, "users"), SC.USERS, ("user_id",), 16)
    early, late = _split(rows)
    for batch in (early, late, late):
        users.upsert(spark, batch, ["ts", "event_id"], ["level"])
    return users.read(spark)


def _store(spark, d, parts: int = 1):
    """The warehouse fact stored by day in ``parts`` appends, and its day dimension."""
    fact = _fact(spark, d)
    root = S.shared_dir(spark, "fact")
    for i in range(parts):
        SF.add_plays(fact.filter(F.pmod("session_id", F.lit(parts)) == i), f"{root}/songplays")
    schema = SF.fact_schema(fact)
    SF.write_days(spark, f"{root}/songplays", schema, f"{root}/days")
    return f"{root}/songplays", schema, f"{root}/days"


@register("compacted_plays", ORACLE["songplays_md5"])
def q_compacted_plays(spark, d):
    """The fact appended to its days in five loads, then compacted: the same rows
    in fewer files."""
    path, schema, _ = _store(spark, d, 5)
    K.compact(spark, path, schema, ["day"], sort_within=["start_time"])
    return spark.read.schema(schema).parquet(path).drop("day")


@register("stored_monthly_users", ORACLE["monthly_unique_users"])
def q_stored_monthly_users(spark, d):
    """A month's distinct users asked of the stored fact through the day dimension."""
    return SF.unique_users(SF.plays_of(spark, *_store(spark, d), IN_MONTH))


@register("stored_top_locations", ORACLE["top_locations"])
def q_stored_top_locations(spark, d):
    """A month's five most played locations, asked of the stored fact."""
    return A.top_locations(SF.plays_of(spark, *_store(spark, d), IN_MONTH), *MONTH)


@register("stored_top_location_artists", ORACLE["top_location_artists"])
def q_stored_top_location_artists(spark, d):
    """A month's top (location, artist) pairs, asked of the stored fact."""
    return A.top_location_artists(SF.plays_of(spark, *_store(spark, d), IN_MONTH), _artists(spark, d), *MONTH)


@register("user_session_stored", ORACLE["user_session"])
def q_user_session_stored(spark, d):
    """One user's session from a stored table whose row groups carry Bloom
    filters of user and session."""
    ev, path = V.staging_events(spark, d), S.shared_dir(spark, "user-sessions")
    table = L.user_sessions(ev)
    L.store_lookup(table, path, ["user_id", "session_id"])
    stored = spark.read.schema(table.schema).parquet(path)
    return L.user_session_lookup(stored, *top_key(ev, "userId", "sessionId"))


@register("song_listeners_stored", ORACLE["song_listeners"])
def q_song_listeners_stored(spark, d):
    """Everyone who played one song, from a stored table with a Bloom filter of songs."""
    ev, path = V.staging_events(spark, d), S.shared_dir(spark, "song-listeners")
    table = L.song_listeners(ev)
    L.store_lookup(table, path, ["song"])
    return L.song_listener_lookup(spark.read.schema(table.schema).parquet(path), *top_key(ev, "song"))


@register("listed_toxic_hits", f"SELECT doc_id, {_hits_sql('text')} AS hits FROM documents")
def q_listed_toxic_hits(spark, d):
    """The flagged words as a table, found in every document in one pass."""
    words = spark.createDataFrame([(w,) for w in TOXIC_WORDS], "word string")
    return W.listed_word_hits(V.read_table(spark, d, "documents"), ["doc_id"], "text", words, "word")


BENCH_WORDS_SQL = r"""
    SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS w FROM benchmark)"""


def _benchmark_words(spark, d):
    b = V.read_table(spark, d, "benchmark")
    return b.select(F.explode(F.regexp_extract_all("text", F.lit(W.TOKEN), F.lit(0))).alias("w"))


@register("benchmark_word_hits", f"""
    SELECT d.doc_id, CAST(count(w.w) AS INTEGER) AS hits
    FROM documents d LEFT JOIN ({BENCH_WORDS_SQL}) w ON contains(coalesce(d.text, 'g'), w.w) GROUP BY d.doc_id""")
def q_benchmark_word_hits(spark, d):
    """How many of all words of the benchmark every document holds anywhere."""
    return W.listed_word_hits(V.read_table(spark, d, "documents"), ["doc_id"], "text", _benchmark_words(spark, d), "w")


@register("benchmark_whole_word_hits", rf"""
    SELECT d.doc_id, CAST(count(w.w) AS INTEGER) AS hits
    FROM documents d
    LEFT JOIN (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS w FROM documents) t ON t.doc_id = d.doc_id
    LEFT JOIN ({BENCH_WORDS_SQL}) w ON w.w = t.w GROUP BY d.doc_id""")
def q_benchmark_whole_word_hits(spark, d):
    """K1/N15 in whole-word form."""
    return W.listed_word_hits(V.read_table(spark, d, "documents"), ["doc_id"], "text", _benchmark_words(spark, d), "w", mode="word")


@register("top_locations_from_states", ORACLE["top_locations"])
def q_top_locations_from_states(spark, d):
    """A month's five most played locations from the daily states of two
    loads; the stored fact is read for those values that the states leave open."""
    path, schema, _ = _store(spark, d)
    fact, states = spark.read.schema(schema).parquet(path), S.shared_dir(spark, "top-states")
    cut = F.to_timestamp(F.lit("2024-01-16 12:00:00"))  # the day of the cut gets states from both loads
    TS.add_days(fact.filter(F.col("start_time") < cut), states, "location")
    TS.add_days(fact.filter(F.col("start_time") >= cut), states, "location")
    return TS.top(spark, states, fact, "location", "day >= DATE '2024-01-01' AND day < DATE '2024-02-01'")
