"""Game-chat toxicity: typed loads, per-match summary, KPIs.

The summary pre-aggregates chat before it meets the match and region tables:
chat -> (match, player, toxic) counts -> one row per match, so the joins see at
most one row per match instead of every message.  Equal to joining first and
grouping by (match_id, match_date, toxic, region) whenever match_id is unique
in matches and cluster_id unique in regions (``key_violations`` checks both;
``match_summary_direct`` is the join-first form for when they are not).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import percent2
from ..functions.text import TOXIC_WORDS, is_flagged
from ..operators.dedup import top_per_group
from ..operators.joins import having_match

# Fixed run stamp used by the registered queries so results are reproducible.
QUERY_RUN_TS = "2024-02-01 00:00:00"
PLAYERS_PER_MATCH = 10


def _stamp(run_ts: str) -> F.Column:
    return F.to_timestamp(F.lit(run_ts))


def chat_typed(raw: DataFrame, run_ts: str = QUERY_RUN_TS) -> DataFrame:
    """chat.csv -> typed chat rows, stamped with the run, exact duplicates removed."""
    return raw.select(
        F.col("match_id").cast("long").alias("match_id"),
        F.col("key").cast("string").alias("chat"),
        F.col("slot").cast("short").alias("slot"),
        F.col("time").cast("int").alias("time_in_seconds"),
        F.col("unit").cast("string").alias("player_name"),
    ).withColumn("date_processed", _stamp(run_ts)).dropDuplicates()


def region_typed(raw: DataFrame, run_ts: str = QUERY_RUN_TS) -> DataFrame:
    return raw.select(
        F.col("cluster").cast("int").alias("cluster_id"),
        F.col("region").cast("string").alias("region"),
    ).withColumn("date_processed", _stamp(run_ts)).dropDuplicates()


def match_typed(raw: DataFrame, run_ts: str = QUERY_RUN_TS) -> DataFrame:
    start = F.timestamp_seconds(F.col("start_time").cast("long"))
    return raw.select(
        F.col("match_id").cast("long").alias("match_id"),
        start.alias("start_time"),
        F.to_date(start).alias("match_date"),
        F.col("duration").cast("int").alias("duration_in_seconds"),
        F.col("tower_status_radiant").cast("int").alias("tower_status_radiant"),
        F.col("tower_status_dire").cast("int").alias("tower_status_dire"),
        F.col("barracks_status_dire").cast("int").alias("barracks_status_dire"),
        F.col("barracks_status_radiant").cast("int").alias("barracks_status_radiant"),
        F.col("first_blood_time").cast("int").alias("first_blood_time"),
        F.col("game_mode").cast("short").alias("game_mode"),
        F.col("radiant_win").cast("boolean").alias("radiant_win"),
        F.col("negative_votes").cast("short").alias("negative_votes"),
        F.col("positive_votes").cast("short").alias("positive_votes"),
        F.col("cluster").cast("int").alias("cluster_id"),
    ).withColumn("date_processed", _stamp(run_ts)).dropDuplicates()


SUMMARY_COLUMNS = ["match_id", "match_date", "toxic", "toxic_count", "toxic_player_count", "region"]


def match_summary(chat: DataFrame, matches: DataFrame, regions: DataFrame,
                  words: Iterable[str] = TOXIC_WORDS, *, strict: bool = False,
                  mode: str = "substring", ignore_case: bool = False) -> DataFrame:
    """One row per match that has chat and a known region.

    toxic: any message hits the word list.  toxic_count / toxic_player_count:
    messages / distinct named players of the toxic messages when the match is
    toxic, else of its (harmless) messages -- the reference's meaning.
    ``strict=True`` adds ``toxic_messages`` (0 for a harmless match).
    """
    return summary_of(chat_by_match(chat, words, mode=mode, ignore_case=ignore_case), matches, regions, strict=strict)


def chat_by_match(chat: DataFrame, words: Iterable[str] = TOXIC_WORDS, *, mode: str = "substring",
                  ignore_case: bool = False) -> DataFrame:
    """Chat flagged and reduced to one row per match (no text crosses a shuffle)."""
    flagged = chat.select("match_id", "player_name",
                          is_flagged("chat", words, mode=mode, ignore_case=ignore_case).alias("toxic"))
    # (match, player, toxic) first: each distinct player of a side is one row,
    # so distinct players become plain counts in the next step.
    per_player = flagged.groupBy("match_id", "player_name", "toxic").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("player_name").isNotNull()
    per_match = per_player.groupBy("match_id").agg(
        F.max(F.col("toxic").cast("int")).alias("has_toxic"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic_msgs"),
        F.sum(F.when(~F.col("toxic"), F.col("n")).otherwise(0)).alias("calm_msgs"),
        F.count(F.when(F.col("toxic") & named, 1)).alias("toxic_players"),
        F.count(F.when(~F.col("toxic") & named, 1)).alias("calm_players"),
    )
    hot = F.col("has_toxic") == 1
    return per_match.select(
        "match_id",
        hot.alias("toxic"),
        F.when(hot, F.col("toxic_msgs")).otherwise(F.col("calm_msgs")).cast("int").alias("toxic_count"),
        F.when(hot, F.col("toxic_players")).otherwise(F.col("calm_players")).cast("int")
         .alias("toxic_player_count"),
        F.col("toxic_msgs").cast("int").alias("toxic_messages"),
    )


def summary_of(per_match: DataFrame, matches: DataFrame, regions: DataFrame, *, strict: bool = False) -> DataFrame:
    """Match rows of ``chat_by_match`` with their date and region."""
    m = matches.select("match_id", "match_date", "cluster_id")
    r = regions.select("cluster_id", "region")
    out = per_match.join(m, "match_id").join(r, "cluster_id")
    cols = SUMMARY_COLUMNS + (["toxic_messages"] if strict else [])
    return out.select(
        F.col("match_id").cast("long"), F.col("match_date").cast("date"), F.col("toxic").cast("boolean"),
        "toxic_count", "toxic_player_count", "region", *(["toxic_messages"] if strict else []),
    ).select(*cols)


def match_summary_direct(chat: DataFrame, matches: DataFrame, regions: DataFrame,
                         words: Iterable[str] = TOXIC_WORDS) -> DataFrame:
    """Join-first form: match x chat x region, group by (match, date, toxic, region),
    then keep the toxic group of each match if it has one (row_number top-1)."""
    c = chat.select("match_id", "player_name", is_flagged("chat", words).cast("int").alias("toxic"))
    m = matches.select("match_id", "match_date", "cluster_id")
    r = regions.select("cluster_id", "region")
    joined = m.join(c, "match_id").join(r, "cluster_id")
    groups = joined.groupBy("match_id", "match_date", "toxic", "region").agg(
        F.count("match_id").alias("toxic_count"),
        F.count_distinct("player_name").alias("toxic_player_count"))
    top = top_per_group(groups, ["match_id"], [F.col("toxic").desc(), "match_date", "region"])
    return top.select(
        F.col("match_id").cast("long"), F.col("match_date").cast("date"),
        F.col("toxic").cast("boolean"), F.col("toxic_count").cast("int"),
        F.col("toxic_player_count").cast("int"), "region")


def summary_with_chat(summary: DataFrame, chat: DataFrame) -> DataFrame:
    """Summary rows whose match has chat (semi join, as the analysis step reads it).
    Give raw chat where there is a choice: only its match ids are read."""
    return having_match(summary, chat.select(F.col("match_id").cast("long").alias("match_id")), "match_id")


def toxic_kpis(summary: DataFrame) -> DataFrame:
    """All three headline ratios in one aggregate pass.

    pct_toxic_matches = toxic / all matches; pct_toxic_players = toxic players /
    (matches x 10).  Percentages are null (not an error) when there is no match.
    """
    agg = summary.agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.count(F.when(F.col("toxic"), 1)).alias("toxic_matches"),
        F.sum(F.when(F.col("toxic"), F.col("toxic_player_count"))).cast("long").alias("toxic_players"),
    )
    return agg.select(
        "total_matches", "toxic_matches",
        (F.col("total_matches") * PLAYERS_PER_MATCH).alias("total_players"),
        "toxic_players",
        percent2("toxic_matches", "total_matches").alias("pct_toxic_matches"),
        percent2("toxic_players", F.col("total_matches") * PLAYERS_PER_MATCH).alias("pct_toxic_players"),
    )


def most_toxic_region(summary: DataFrame) -> DataFrame:
    """Region with the most toxic matches (ties -> smaller name) and its share of
    *all* matches.  Empty when no match is toxic.

    One grouped aggregate gives per-region counts (a row per region, bounded by
    the region dimension); one global aggregate over those rows then picks the
    top region with ``min_by`` on (most toxic, non-null name, smaller name) and
    sums all matches in the same pass -- no window, no subquery, no second
    pass over the summary.
    """
    per_region = summary.groupBy("region").agg(
        F.count(F.when(F.col("toxic"), 1)).alias("toxic_matches"),
        F.count(F.lit(1)).alias("matches"))
    rank = F.when(F.col("toxic_matches") > 0,
                  F.struct((-F.col("toxic_matches")).alias("k0"), F.col("region").isNull().alias("k1"),
                           F.col("region").alias("k2")))
    one = per_region.agg(F.min_by(F.struct("region", "toxic_matches"), rank).alias("top"),
                         F.sum("matches").alias("total_matches"))
    return one.filter(F.col("top").isNotNull()).select(
        F.col("top.region").alias("region"), F.col("top.toxic_matches").alias("toxic_matches"),
        percent2("top.toxic_matches", "total_matches").alias("pct_of_matches"))


def word_hits(docs: DataFrame, id_col: str, text_col: str, words: Iterable[str] = TOXIC_WORDS,
              mode: str = "substring", ignore_case: bool = False) -> DataFrame:
    """Per document: number of listed words it contains (whole text) and the flag."""
    from ..functions.text import flag_word_hits
    hits = flag_word_hits(text_col, words, mode=mode, ignore_case=ignore_case)
    return docs.select(F.col(id_col), hits.alias("hits")).withColumn("toxic", F.col("hits") > 0)
