"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracle text.

Every query reads the driver's whole tables (through ``sources.views``); none
runs on made-up input.  Oracle SQL is written from the reference's semantics
(join-first, window-based where the reference is), independently of the Spark
plan, so a match is evidence the Spark-first rewrite is equivalent.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..sources import views as V
from ..operators import dq
from . import toxicity as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            S.configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco


# --------------------------------------------------------------------------
# Chat toxicity domain: typed loads

def _chat(spark, d):
    return T.chat_typed(V.chat_raw(spark, d))


def _matches(spark, d):
    return T.match_typed(V.match_raw(spark, d))


def _regions(spark, d):
    return T.region_typed(V.region_raw(spark, d))


RUN_TS_SQL = "TIMESTAMP '2024-02-01 00:00:00'"

DUCK_TYPED = {
    "chat_t": (f"""
        SELECT DISTINCT CAST(match_id AS BIGINT) AS match_id, CAST(key AS VARCHAR) AS chat,
               CAST(slot AS SMALLINT) AS slot, CAST(time AS INTEGER) AS time_in_seconds,
               CAST(unit AS VARCHAR) AS player_name, {RUN_TS_SQL} AS date_processed
        FROM chat_raw""", ("chat_raw",)),
    "region_t": (f"""
        SELECT DISTINCT CAST(cluster AS INTEGER) AS cluster_id, CAST(region AS VARCHAR) AS region,
               {RUN_TS_SQL} AS date_processed
        FROM region_raw""", ("region_raw",)),
    "match_t": (f"""
        SELECT DISTINCT CAST(match_id AS BIGINT) AS match_id,
               epoch_ms(CAST(start_time AS BIGINT) * 1000) AS start_time,
               CAST(epoch_ms(CAST(start_time AS BIGINT) * 1000) AS DATE) AS match_date,
               CAST(duration AS INTEGER) AS duration_in_seconds,
               CAST(tower_status_radiant AS INTEGER) AS tower_status_radiant,
               CAST(tower_status_dire AS INTEGER) AS tower_status_dire,
               CAST(barracks_status_dire AS INTEGER) AS barracks_status_dire,
               CAST(barracks_status_radiant AS INTEGER) AS barracks_status_radiant,
               CAST(first_blood_time AS INTEGER) AS first_blood_time,
               CAST(game_mode AS SMALLINT) AS game_mode,
               CAST(radiant_win AS BOOLEAN) AS radiant_win,
               CAST(negative_votes AS SMALLINT) AS negative_votes,
               CAST(positive_votes AS SMALLINT) AS positive_votes,
               CAST(cluster AS INTEGER) AS cluster_id,
               {RUN_TS_SQL} AS date_processed
        FROM match_raw""", ("match_raw",)),
}


def duck(sql: str, *views: str) -> str:
    return V.duckdb_with(sql, *views, extra=DUCK_TYPED)


def _flag_sql(col: str) -> str:
    from ..functions.text import NULL_CHAT, TOXIC_WORDS
    c = f"coalesce({col}, '{NULL_CHAT}')"
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in TOXIC_WORDS) + ")"


def _hits_sql(col: str) -> str:
    from ..functions.text import NULL_CHAT, TOXIC_WORDS
    c = f"coalesce({col}, '{NULL_CHAT}')"
    return "(" + " + ".join(f"CAST(contains({c}, '{w}') AS INTEGER)" for w in TOXIC_WORDS) + ")"


@register("chat_typed", duck("SELECT * FROM chat_t", "chat_t"))
def q_chat_typed(spark, d):
    """Chat.csv renamed + cast, run stamp, exact duplicates dropped."""
    return _chat(spark, d)


@register("match_typed", duck("SELECT * FROM match_t", "match_t"))
def q_match_typed(spark, d):
    """Match.csv typed; epoch seconds -> timestamp and date."""
    return _matches(spark, d)


@register("region_typed", duck("SELECT * FROM region_t", "region_t"))
def q_region_typed(spark, d):
    return _regions(spark, d)


# Join-first oracle of the match summary (the reference's own formulation).
SUMMARY_SQL = f"""
    SELECT CAST(match_id AS BIGINT) AS match_id, CAST(match_date AS DATE) AS match_date,
           CAST(toxic AS BOOLEAN) AS toxic, CAST(toxic_count AS INTEGER) AS toxic_count,
           CAST(toxic_player_count AS INTEGER) AS toxic_player_count, region
    FROM (
      SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY match_id, toxic DESC) AS rn
      FROM (
        SELECT m.match_id, m.match_date, c.toxic, r.region,
               count(m.match_id) AS toxic_count, count(DISTINCT c.player_name) AS toxic_player_count
        FROM (SELECT match_id, match_date, cluster_id FROM match_t) m
        JOIN (SELECT match_id, player_name,
                     CASE WHEN {_flag_sql('chat')} THEN 1 ELSE 0 END AS toxic FROM chat_t) c
          ON m.match_id = c.match_id
        JOIN region_t r ON m.cluster_id = r.cluster_id
        GROUP BY m.match_id, m.match_date, c.toxic, r.region))
    WHERE rn = 1"""


@register("match_summary", duck(SUMMARY_SQL, "match_t", "chat_t", "region_t"))
def q_match_summary(spark, d):
    """M8: per-match toxicity summary (pre-aggregated chat, then joins)."""
    return T.match_summary(_chat(spark, d), _matches(spark, d), _regions(spark, d))


@register("match_summary_direct", duck(SUMMARY_SQL, "match_t", "chat_t", "region_t"))
def q_match_summary_direct(spark, d):
    """M8 in join-first form with the row_number top-1 window (F1)."""
    return T.match_summary_direct(_chat(spark, d), _matches(spark, d), _regions(spark, d))


@register("match_summary_strict", duck(f"""
    SELECT s.*, CAST(coalesce(t.n, 0) AS INTEGER) AS toxic_messages
    FROM ({SUMMARY_SQL}) s
    LEFT JOIN (SELECT match_id, count(*) AS n FROM chat_t WHERE {_flag_sql('chat')} GROUP BY match_id) t
      ON s.match_id = t.match_id""", "match_t", "chat_t", "region_t"))
def q_match_summary_strict(spark, d):
    """M8 + N13: adds the true number of toxic messages per match."""
    return T.match_summary(_chat(spark, d), _matches(spark, d), _regions(spark, d), strict=True)


def _pct_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN CAST((CAST({num} AS BIGINT) * 20000 + ({den})) // (2 * ({den})) AS DOUBLE) / 100.0 END"


KPI_BASE = f"""
    SELECT s.* FROM ({SUMMARY_SQL}) s
    WHERE s.match_id IN (SELECT match_id FROM chat_t)"""


@register("toxic_kpis", duck(f"""
    SELECT total_matches, toxic_matches, total_matches * 10 AS total_players, toxic_players,
           {_pct_sql('toxic_matches', 'total_matches')} AS pct_toxic_matches,
           {_pct_sql('toxic_players', 'total_matches * 10')} AS pct_toxic_players
    FROM (SELECT count(*) AS total_matches,
                 count(*) FILTER (WHERE toxic) AS toxic_matches,
                 CAST(sum(CASE WHEN toxic THEN toxic_player_count END) AS BIGINT) AS toxic_players
          FROM ({KPI_BASE}))""", "match_t", "chat_t", "region_t"))
def q_toxic_kpis(spark, d):
    """M9: share of toxic matches and toxic players (one aggregate pass)."""
    summary = T.match_summary(_chat(spark, d), _matches(spark, d), _regions(spark, d))
    return T.toxic_kpis(T.summary_with_chat(summary, V.chat_raw(spark, d)))


@register("most_toxic_region", duck(f"""
    SELECT region, toxic_matches, {_pct_sql('toxic_matches', 'total')} AS pct_of_matches
    FROM (SELECT region, count(*) AS toxic_matches,
                 (SELECT count(*) FROM ({KPI_BASE})) AS total
          FROM ({KPI_BASE}) WHERE toxic GROUP BY region)
    ORDER BY toxic_matches DESC, region ASC LIMIT 1""", "match_t", "chat_t", "region_t"))
def q_most_toxic_region(spark, d):
    """Region with the most toxic matches, as a share of all matches."""
    summary = T.match_summary(_chat(spark, d), _matches(spark, d), _regions(spark, d))
    return T.most_toxic_region(T.summary_with_chat(summary, V.chat_raw(spark, d)))


@register("toxic_word_hits", f"""
    SELECT doc_id, {_hits_sql('text')} AS hits, {_hits_sql('text')} > 0 AS toxic FROM documents""")
def q_toxic_word_hits(spark, d):
    """I4/K1: listed-word hits over every document's whole text."""
    return T.word_hits(V.read_table(spark, d, "documents"), "doc_id", "text")


@register("chat_message_flags", duck(f"""
    SELECT match_id, player_name, time_in_seconds, {_hits_sql('chat')} AS hits
    FROM chat_t""", "chat_t"))
def q_chat_message_flags(spark, d):
    """Hits per chat message (a null message counts as harmless)."""
    from ..functions.text import flag_word_hits
    return _chat(spark, d).select("match_id", "player_name", "time_in_seconds",
                                  flag_word_hits("chat").alias("hits"))


# --------------------------------------------------------------------------
# Data quality

def _orphan_sql(src: str, skey: str, tgt: str, tkey: str, sname: str, tname: str) -> str:
    return f"""
    SELECT '{sname}' AS source, '{tname}' AS target, count(*) AS orphan_keys,
           CASE WHEN count(*) = 0 THEN 'Success' ELSE 'Failed' END AS status
    FROM (SELECT DISTINCT {skey} AS k FROM {src}) s
    WHERE NOT EXISTS (SELECT 1 FROM {tgt} t WHERE t.{tkey} = s.k)"""


@register("orphans_chat_match", duck(_orphan_sql("chat_t", "match_id", "match_t", "match_id",
                                                 "chat_data", "match_data"), "chat_t", "match_t"))
def q_orphans_chat_match(spark, d):
    """L2: chats whose match is unknown."""
    return dq.orphan_check(_chat(spark, d), _matches(spark, d), "match_id", "match_id",
                           "chat_data", "match_data")


@register("orphans_match_region", duck(_orphan_sql("match_t", "cluster_id", "region_t", "cluster_id",
                                                   "match_data", "cluster_regions_data"),
                                       "match_t", "region_t"))
def q_orphans_match_region(spark, d):
    """L2: matches whose cluster has no region."""
    return dq.orphan_check(_matches(spark, d), _regions(spark, d), "cluster_id", "cluster_id",
                           "match_data", "cluster_regions_data")


@register("orphans_match_chat", duck(_orphan_sql("match_t", "match_id", "chat_t", "match_id",
                                                 "match_data", "chat_data"), "match_t", "chat_t"))
def q_orphans_match_chat(spark, d):
    """L2: matches without any chat."""
    return dq.orphan_check(_matches(spark, d), _chat(spark, d), "match_id", "match_id",
                           "match_data", "chat_data")


@register("run_record_counts", duck(f"""
    SELECT 'chat_data' AS table_name, count(*) AS rows, count(*) > 0 AS ok
      FROM chat_t WHERE date_processed = {RUN_TS_SQL}
    UNION ALL
    SELECT 'match_data', count(*), count(*) > 0 FROM match_t WHERE date_processed = {RUN_TS_SQL}
    UNION ALL
    SELECT 'cluster_regions_data', count(*), count(*) > 0 FROM region_t
      WHERE date_processed = {RUN_TS_SQL}""", "chat_t", "match_t", "region_t"))
def q_run_record_counts(spark, d):
    """L1: rows each table received in this run."""
    run = f"date_processed = TIMESTAMP '{T.QUERY_RUN_TS}'"  # SQL-string predicate, as the reference writes it
    return dq.run_record_counts({"chat_data": _chat(spark, d), "match_data": _matches(spark, d),
                                 "cluster_regions_data": _regions(spark, d)}, run)


# Domain A (music plays) and file/sink queries register themselves on import.
from . import queries_music  # noqa: E402,F401
from . import queries_io  # noqa: E402,F401
from . import queries_stored  # noqa: E402,F401
