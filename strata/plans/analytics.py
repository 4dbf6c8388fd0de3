"""Warehouse questions over the songplays fact.

Counting is pushed below the artist join: plays are first counted per
(location, artist_id), so a hot artist reaches the join as one row per
location instead of every play.  Summing those counts over the joined artist
rows equals counting the joined plays, duplicates in the artist table included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import top_per_group


def in_range(df: DataFrame, start: str, end: str, col: str = "start_time") -> DataFrame:
    """Half-open time range [start, end)."""
    return df.filter((F.col(col) >= F.to_timestamp(F.lit(start))) & (F.col(col) < F.to_timestamp(F.lit(end))))


def unique_users(fact: DataFrame, start: str, end: str, approx: bool = False) -> DataFrame:
    u = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return in_range(fact, start, end).agg(u.alias("unique_users"))


def _location_artist_counts(fact: DataFrame, start: str, end: str) -> DataFrame:
    """Plays per (location, artist_id), plays without an artist included."""
    return in_range(fact, start, end).groupBy("location", "artist_id").agg(F.count(F.lit(1)).alias("n"))


def _top(streams: DataFrame, n: int, *ties: str) -> DataFrame:
    return streams.orderBy(F.col("streams").desc(), *[F.col(c).asc_nulls_last() for c in ties]).limit(n)


def top_locations(fact: DataFrame, start: str, end: str, n: int = 5) -> DataFrame:
    counts = in_range(fact, start, end).groupBy("location").agg(F.count(F.lit(1)).alias("streams"))
    return _top(counts, n, "location")


def _by_artist_name(counts: DataFrame, artists: DataFrame) -> DataFrame:
    j = counts.join(artists.select("artist_id", "name"), "artist_id")
    return j.groupBy("location", "name").agg(F.sum("n").alias("streams"))


def top_location_artists(fact: DataFrame, artists: DataFrame, start: str, end: str, n: int = 5) -> DataFrame:
    """Global top-n (location, artist name) pairs by plays (as the warehouse query is written)."""
    return _top(_by_artist_name(_location_artist_counts(fact, start, end), artists), n, "location", "name")


def top_artist_per_location(fact: DataFrame, artists: DataFrame, start: str, end: str,
                            n_locations: int = 5) -> DataFrame:
    """The question as asked: for each of the top-n locations, its most played artist.

    Both sides start from one (location, artist_id) count, whose exchange Spark
    reuses, so the fact is built once; location totals are sums of those counts."""
    counts = _location_artist_counts(fact, start, end)
    locs = _top(counts.groupBy("location").agg(F.sum("n").alias("streams")), n_locations, "location").select("location")
    s = _by_artist_name(counts, artists).join(locs, "location", "left_semi")
    return top_per_group(s, ["location"], [F.col("streams").desc(), F.col("name").asc_nulls_last()])
