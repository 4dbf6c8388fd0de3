"""Distinct users from daily states instead of the fact.

A day's users are bitmaps: one row for each 32,768 consecutive user ids that the day
touches.  States of any days merge by a bitwise or, so a month (or any run of days)
is answered exactly from its states, without the fact.  Merging is idempotent: plays
that arrive late, or twice, are appended as further state rows of their day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, LongType, StructField, StructType

from ..sinks import write_parquet

STATE = StructType([StructField("bucket", LongType(), True), StructField("users", BinaryType(), True),
                    StructField("day", DateType(), True)])


def daily_users(fact: DataFrame) -> DataFrame:
    """(bucket, users, day) of a fact with start_time and user_id; plays without a
    user count for nobody.  Bitmaps are built map-side, so what is shuffled is at
    most one bitmap per task, day and bucket."""
    return fact.filter("user_id IS NOT NULL").groupBy(
        F.to_date("start_time").alias("day"), F.bitmap_bucket_number(F.col("user_id").cast("long")).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("user_id").cast("long"))).alias("users")).select("bucket", "users", "day")


def add_days(plays: DataFrame, path: str) -> int:
    """Append the states of some plays; returns the state rows written."""
    return write_parquet(daily_users(plays), path, "append", ["day"])


def unique_users(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Distinct users of the days in [start, end), dates as text; reads the states
    of those days only."""
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    states = spark.read.schema(STATE).parquet(path).filter((F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(hi)))
    merged = states.groupBy("bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias("unique_users"))


def unique_users_by_month(spark: SparkSession, path: str) -> DataFrame:
    """(month, unique_users) of every month with plays, from one pass over the states."""
    states = spark.read.schema(STATE).parquet(path).withColumn("month", F.trunc("day", "month"))
    return states.groupBy("month", "bucket").agg(F.bitmap_or_agg("users").alias("users")) \
        .groupBy("month").agg(F.sum(F.bitmap_count("users")).alias("unique_users"))
