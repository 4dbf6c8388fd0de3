"""The songplays fact stored by day, and questions asked of it through a day dimension.

The fact is partitioned by the day of its start time.  A question filters the day
dimension (year, month, weekday ...) and joins: Spark broadcasts the few days left and
prunes the fact's directories by them at run time (dynamic partition pruning), so a
month's question reads a month of a fact of any length, also where the filter
cannot be written as a range of days ("every Monday of 2024").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from ..sinks import single_file_overwrite, write_parquet

DAYS = StructType([StructField("day", DateType(), True), StructField("year", IntegerType(), True),
                   StructField("month", IntegerType(), True), StructField("weekday", IntegerType(), True)])


def add_plays(plays: DataFrame, path: str) -> int:
    """Append plays to the stored fact, sorted by time within files; returns their number."""
    return write_parquet(plays.withColumn("day", F.to_date("start_time")), path, "append", ["day"], ["start_time"])


def fact_schema(plays: DataFrame) -> StructType:
    return StructType([*plays.schema.fields, StructField("day", DateType(), True)])


def write_days(spark: SparkSession, fact_path: str, schema: StructType, path: str) -> int:
    """The day dimension of a stored fact: its days, from the partition column alone."""
    day = spark.read.schema(schema).parquet(fact_path).select("day").filter("day IS NOT NULL").distinct()
    days = day.select("day", F.year("day").alias("year"), F.month("day").alias("month"), F.dayofweek("day").alias("weekday"))
    return single_file_overwrite(days, path)


def plays_of(spark: SparkSession, fact_path: str, schema: StructType, days_path: str, days: str) -> DataFrame:
    """The stored plays of the days that satisfy ``days``, a predicate on the day dimension."""
    chosen = spark.read.schema(DAYS).parquet(days_path).filter(days).select("day")
    return spark.read.schema(schema).parquet(fact_path).join(chosen, "day", "left_semi").drop("day")


def unique_users(plays: DataFrame) -> DataFrame:
    return plays.agg(F.count_distinct("user_id").alias("unique_users"))
