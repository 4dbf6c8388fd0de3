"""Load order of the two jobs as one driver function each (no scheduler).

chat:  chat, region, match loads -> row-count and orphan checks -> summary
star:  stage events -> songplays fact -> dimensions -> non-empty gate
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from .. import schemas as SC
from ..operators import dq
from ..operators.joins import having_match
from ..session import shared_dir
from ..sinks import (KeyIndex, incremental_load, load_table, replace_values, single_file_overwrite, touched_partitions,
                     write_directories, write_parquet)
from ..sources.files import path_exists, stage_json
from . import star as ST
from . import toxicity as T


class DataQualityError(RuntimeError):
    pass


@dataclass
class RunReport:
    loaded: dict[str, int] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return all(c.get("ok", c.get("status") == "Success") for c in self.checks)


CHAT_STORED = StructType(SC.CHAT.fields + [StructField("run_date", DateType(), True)])
# Matches and summaries lie by the year of the match and sorted by date in a file.  One
# directory per date costs every run a file, a listing and a rename for each date of the
# history; by year a question about a date still skips the row groups of the others.
MATCH_STORED = StructType(SC.MATCH.fields + [StructField("match_year", IntegerType(), True)])
SUMMARY_STORED = StructType(SC.MATCH_SUMMARY.fields + [StructField("match_year", IntegerType(), True)])
MATCH_ORDER = ("match_year", "match_date")


def chat_paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {"chat": f"{r}/chat_data", "match": f"{r}/match_data", "region": f"{r}/cluster_regions_data",
            "summary": f"{r}/match_summary_data"}


# Keys of the chat load.  The reference keys chat by match, so late lines of a
# loaded match are skipped; the row key accepts them (with ``refresh``).
CHAT_MATCH_KEY = ("match_id",)
CHAT_ROW_KEY = ("match_id", "slot", "time_in_seconds", "player_name", "chat")


def _gate(rep: RunReport, raise_on_fail: bool) -> None:
    if raise_on_fail and not rep.ok:
        raise DataQualityError(rep.checks)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """A frame that several jobs of the run read, written once."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _by_year(matches: DataFrame) -> DataFrame:
    return matches.withColumn("match_year", F.year("match_date"))


def _without_chat(index: KeyIndex, matches: DataFrame) -> DataFrame:
    """Distinct match ids that no chat file holds (a null id never has chat)."""
    ids = matches.select("match_id").distinct()
    return index.missing(ids.filter("match_id IS NOT NULL")).unionByName(ids.filter("match_id IS NULL"))


def run_chat_etl(spark: SparkSession, chat_raw: DataFrame, match_raw: DataFrame, region_raw: DataFrame,
                 root: str, run_ts: str, *, raise_on_fail: bool = False, refresh: bool = False,
                 chat_key: Sequence[str] | None = None) -> RunReport:
    """Typed incremental loads, checks and their gate, then the per-match summary.

    Chat is partitioned by the run's date (``run_date``) and keeps the exact
    run stamp as a column; matches and summary are partitioned by the match's year.
    With ``raise_on_fail`` a failed check ends the run before the summary.

    Default (the reference's behaviour): chat is keyed by match, and only
    matches without a summary are summarised and appended -- a late line of a
    loaded match is dropped and a summary never changes.  ``refresh=True``
    keys chat by row (``chat_key`` overrides either default), so late lines are
    loaded.  The summaries of every match date that the run changes are then
    recomputed and overwritten: dates of matches with chat from this run, of
    matches loaded in this run, and of matches that have chat and a region but
    no summary yet (a late match or region).  Other dates keep their rows.

    What a run reads of older chat and summaries: the bitmaps of their match ids
    (``KeyIndex``), and of the data files only those that hold a match that the
    run compares row by row or summarises.
    """
    p = chat_paths(root)
    rep = RunReport(paths=p)
    key = list(chat_key or (CHAT_ROW_KEY if refresh else CHAT_MATCH_KEY))
    chat = T.chat_typed(chat_raw, run_ts).withColumn("run_date", F.to_date("date_processed"))
    # Chat files are sorted by match within each task: few row groups hold a match.
    index = KeyIndex(spark, p["chat"], "match_id", CHAT_STORED)
    if path_exists(spark, p["chat"]) and "match_id" in key:
        index.refresh()
        if key == ["match_id"]:
            todo = index.missing(chat)
        else:
            known = index.read(chat).select(*key).distinct()
            todo = chat.join(known, reduce(and_, [chat[k].eqNullSafe(known[k]) for k in key]), "left_anti")
        rep.loaded["chat_data"] = write_parquet(todo, p["chat"], "append", ["run_date"], ["match_id"])
    else:
        rep.loaded["chat_data"] = incremental_load(spark, chat, p["chat"], key, ["run_date"], schema=CHAT_STORED,
                                                   sort_within=["match_id"])
    index.refresh()
    rep.loaded["cluster_regions_data"] = single_file_overwrite(T.region_typed(region_raw, run_ts), p["region"])
    rep.loaded["match_data"] = incremental_load(spark, _by_year(T.match_typed(match_raw, run_ts)), p["match"],
                                                ["match_id"], ["match_year"], schema=MATCH_STORED,
                                                prune_by=["match_year"], sort_within=MATCH_ORDER)

    chat_t = spark.read.schema(CHAT_STORED).parquet(p["chat"])
    match_t = spark.read.schema(MATCH_STORED).parquet(p["match"])
    region_t = spark.read.schema(SC.REGION).parquet(p["region"])
    run = F.col("date_processed") == F.to_timestamp(F.lit(run_ts))
    new_chat = chat_t.filter((F.col("run_date") == F.to_date(F.to_timestamp(F.lit(run_ts)))) & run)
    counts = dq.run_record_counts({"chat_data": new_chat, "match_data": match_t,
                                   "cluster_regions_data": region_t}, run)
    orphans = (dq.orphan_check(new_chat, match_t, "match_id", "match_id", "chat_data", "match_data")
               .unionByName(dq.orphan_check(match_t, region_t, "cluster_id", "cluster_id",
                                            "match_data", "cluster_regions_data"))
               .unionByName(dq.orphan_row(_without_chat(index, match_t), "match_data", "chat_data")))
    # Both results are a handful of rows (one per table / per check).
    rep.checks = [r.asDict() for r in counts.collect()] + [r.asDict() for r in orphans.collect()]
    _gate(rep, raise_on_fail)

    ready = match_t.join(region_t.select("cluster_id").distinct(), "cluster_id", "left_semi").select(*match_t.columns)
    done = KeyIndex(spark, p["summary"], "match_id", SUMMARY_STORED)
    done.refresh()
    todo = done.missing(ready) if path_exists(spark, p["summary"]) else ready
    if refresh:
        waiting = todo.join(index.hits(todo).select("match_id").distinct(), "match_id", "left_semi").select("match_date")
        dates = stored(having_match(match_t, new_chat, "match_id").select("match_date")
                        .unionByName(match_t.filter(run).select("match_date")).unionByName(waiting).distinct(), "dates")
        todo = match_t.where(touched_partitions(_by_year(dates), ["match_year"]))
        todo = todo.join(dates, todo["match_date"].eqNullSafe(dates["match_date"]), "left_semi")
    todo = stored(todo, "todo")
    lines = index.read(todo)
    # Reduced to one row per match before it meets the matches: no text is shuffled.
    per_match = T.chat_by_match(lines)
    summary = _by_year(T.summary_of(per_match, todo, region_t))
    if refresh:
        n = replace_values(spark, stored(summary, "summary"), p["summary"], "match_date", ["match_year"],
                           schema=SUMMARY_STORED, sort_within=MATCH_ORDER)
    else:
        n = write_parquet(summary, p["summary"], "append", ["match_year"], MATCH_ORDER)
    rep.loaded["match_summary_data"] = n
    done.refresh()
    return rep


# Layout of the songs table.  One directory per (year, artist_id), the
# reference's choice, grows with the artists and costs a file, a listing and a
# rename each; by year, and sorted by artist within a file, a lookup of one
# artist still skips the row groups of the others.
SONGS_BY = ("year",)


def write_songs(songs: DataFrame, path: str, by: Sequence[str] = SONGS_BY) -> int:
    rest = [c for c in ("artist_id", "song_id") if c not in by]
    if "artist_id" in by:
        return write_directories(songs, path, list(by), sort_within=[*by, *rest])
    return write_parquet(songs, path, "overwrite", list(by), sort_within=[*by, *rest])


def star_paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {t: f"{r}/{t}" for t in ("staging_events", "songplays", "users", "songs", "artists", "time")}


def run_star_etl(spark: SparkSession, log_template: str, songs: DataFrame, root: str, *,
                 raise_on_fail: bool = True, append_fact: bool = False, songs_by: Sequence[str] = SONGS_BY,
                 **params) -> RunReport:
    """Stage the run's event JSON, load the fact, refresh the dimensions, gate.

    The stage holds this run's files only, so what is built from it is added:
    the fact by its whole row (a repeated run adds nothing; ``append_fact=True``
    is the plain append) and users by theirs.  Songs and artists come from the
    complete song table and time from the whole fact, so these are overwritten.
    The gate fails on an empty table."""
    p = star_paths(root)
    rep = RunReport(paths=p)
    songs = stored(songs, "song-rows")  # the fact and two dimensions read them
    rep.loaded["staging_events"] = stage_json(spark, log_template, SC.EVENT_JSON, p["staging_events"], **params)
    events = spark.read.schema(SC.EVENT_JSON).parquet(p["staging_events"])
    plays = stored(ST.songplays_warehouse(events, songs), "plays")
    if append_fact:
        rep.loaded["songplays"] = load_table(plays, p["songplays"], append=True)
    else:
        rep.loaded["songplays"] = incremental_load(spark, plays, p["songplays"], SC.SONGPLAYS.fieldNames(), schema=SC.SONGPLAYS,
                                                   range_by=["start_time"], sort_within=["start_time"])
    rep.loaded["users"] = incremental_load(spark, ST.users_dim(events, "distinct"), p["users"], SC.USERS.fieldNames(),
                                           schema=SC.USERS)
    rep.loaded["songs"] = write_songs(ST.songs_dim(songs, "distinct"), p["songs"], songs_by)
    rep.loaded["artists"] = load_table(ST.artists_dim(songs, "distinct"), p["artists"], append=False)
    fact = spark.read.schema(SC.SONGPLAYS).parquet(p["songplays"])
    rep.loaded["time"] = write_parquet(ST.time_dim(fact, convention="warehouse"), p["time"], "overwrite",
                                       ["year", "month"])
    tables = {t: spark.read.schema(SC.TABLES[t]).parquet(p[t])
              for t in ("songplays", "users", "songs", "artists", "time")}
    rep.checks = [r.asDict() for r in dq.nonempty_tables(tables).collect()]
    _gate(rep, raise_on_fail)
    return rep


def lake_paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {t: f"{r}/{t}" for t in ("songs", "artists", "users", "time", "songplays")}


def run_lake_etl(spark: SparkSession, song_glob: str, log_glob: str, root: str,
                 songs_by: Sequence[str] = SONGS_BY) -> RunReport:
    """Data-lake job: song and log JSON -> parquet star schema.

    songs partitioned by ``songs_by``; time and songplays by (year, month);
    every table overwritten per run.  The fact joins plays to the songs just
    written (read back, so the partitioned layout is what is joined)."""
    from ..sources.files import read_json
    p = lake_paths(root)
    rep = RunReport(paths=p)
    songs_src = read_json(spark, song_glob, SC.SONG_JSON)
    rep.loaded["songs"] = write_songs(ST.songs_dim(songs_src, "none"), p["songs"], songs_by)
    rep.loaded["artists"] = write_parquet(ST.artists_dim(songs_src, "distinct"), p["artists"], "overwrite")
    events = read_json(spark, log_glob, SC.EVENT_JSON)
    rep.loaded["users"] = write_parquet(ST.users_dim(events, "none"), p["users"], "overwrite")
    plays_ts = ST.plays(events).select(F.timestamp_millis("ts").alias("start_time"))
    rep.loaded["time"] = write_parquet(ST.time_dim(plays_ts, convention="spark"), p["time"], "overwrite",
                                       ["year", "month"])
    songs = spark.read.schema(SC.SONGS).parquet(p["songs"])
    rep.loaded["songplays"] = write_parquet(ST.songplays_lake(events, songs), p["songplays"], "overwrite",
                                            ["year", "month"])
    return rep
