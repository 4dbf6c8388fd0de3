"""Query-shaped tables keyed for one question each (wide-row tables whose
primary key is partition key + clustering key; a later write of the same key
replaces the earlier one).

  session_items  key (sessionId, itemInSession): artist, song, length
  user_sessions  key (userId, sessionId, itemInSession): artist, song, user
  song_listeners key (song, user)

Built from the event CSV shape: every page, rows with an empty artist dropped.
Point lookups filter on the key columns; written with ``partitionBy`` on the
partition key, the same filter prunes whole directories.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import full_name
from ..operators.dedup import last_by_key
from ..sinks import bloom_options, write_parquet

ARRIVAL = ("ts", "event_id")


def event_rows(events: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """The 11 used CSV columns, rows with a non-empty artist (CSV reads '' as null)."""
    keep = events.filter(F.col("artist").isNotNull() & (F.col("artist") != ""))
    cols = ["artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
            "location", "sessionId", "song", "userId", *arrival]
    return keep.select(*[c for c in cols if c in events.columns])


def session_items(events: DataFrame, order_by: Sequence[str] = ARRIVAL) -> DataFrame:
    rows = event_rows(events, order_by).select(
        F.col("sessionId").cast("long").alias("session_id"),
        F.col("itemInSession").cast("int").alias("item_in_session"),
        "artist", "song", F.col("length").cast("float").alias("length"), *order_by)
    return last_by_key(rows, ["session_id", "item_in_session"], list(order_by)).drop(*order_by)


def user_sessions(events: DataFrame, order_by: Sequence[str] = ARRIVAL) -> DataFrame:
    rows = event_rows(events, order_by).select(
        F.col("userId").cast("long").alias("user_id"),
        F.col("sessionId").cast("long").alias("session_id"),
        F.col("itemInSession").cast("int").alias("item_in_session"),
        "artist", "song", full_name("firstName", "lastName").alias("user"), *order_by)
    return last_by_key(rows, ["user_id", "session_id", "item_in_session"], list(order_by)).drop(*order_by)


def song_listeners(events: DataFrame) -> DataFrame:
    return event_rows(events).select("song", full_name("firstName", "lastName").alias("user")).distinct()


def store_lookup(table: DataFrame, path: str, by: Sequence[str], values_per_row_group: int = 100_000,
                 options: dict[str, str] | None = None) -> int:
    """Store a lookup table with a Bloom filter on each of ``by`` in every row group, so a
    lookup reads only row groups that may hold its key.  The key may have any number of
    values: it needs no directories and no sort order.  A filter for 100,000 values takes
    some 128 KB of a row group; more values only make it let more row groups pass."""
    return write_parquet(table, path, options={**bloom_options({c: values_per_row_group for c in by}), **(options or {})})


def session_item_lookup(table: DataFrame, session_id: int, item_in_session: int) -> DataFrame:
    return table.filter((F.col("session_id") == session_id) & (F.col("item_in_session") == item_in_session)) \
        .select("artist", "song", "length")


def user_session_lookup(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """Artist, song and user of one user's session in item order."""
    return table.filter((F.col("user_id") == user_id) & (F.col("session_id") == session_id)) \
        .orderBy("item_in_session").select("item_in_session", "artist", "song", "user")


def song_listener_lookup(table: DataFrame, song: str) -> DataFrame:
    return table.filter(F.col("song") == song).select("user")
