"""The most frequent values of any days from small daily states, exactly.

A load keeps, for each of its days, the ``keep`` most frequent values with their counts,
and the count of the next one: the cut, which no value left out exceeds.  Over any days a
value has at least the sum of its kept counts, and at most that plus the cuts of the states
that do not list it.  Only values whose upper bound reaches the n-th best lower bound are
counted again in the fact; where no state has left anything out the fact is not read,
and where a value that no state lists could still be among the best, all are counted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ..sinks import write_parquet

STATE = StructType([StructField("load", StringType(), True), StructField("value", StringType(), True),
                    StructField("n", LongType(), True), StructField("cut", LongType(), True),
                    StructField("day", DateType(), True)])


def daily_top(plays: DataFrame, column: str, keep: int) -> DataFrame:
    """(value, n, cut, day): a null value counts as one, as in a grouping."""
    counts = plays.groupBy(F.to_date("start_time").alias("day"), F.col(column).cast("string").alias("value")) \
        .agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("day").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    listed = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep + 1)
    over = F.max(F.when(F.col("rank") == keep + 1, F.col("n"))).over(Window.partitionBy("day"))
    return listed.withColumn("cut", F.coalesce(over, F.lit(0))).filter(F.col("rank") <= keep).select("value", "n", "cut", "day")


def add_days(plays: DataFrame, path: str, column: str, keep: int = 100) -> int:
    """Append the states of one load's plays; a day may get states from several loads."""
    load = F.lit(uuid.uuid4().hex)
    return write_parquet(daily_top(plays, column, keep).select(load.alias("load"), "value", "n", "cut", "day"), path, "append", ["day"])


def bounds(states: DataFrame) -> tuple[DataFrame, int]:
    """(value, low, high), and what a value that no state lists can have at most."""
    slack = states.select("load", "day", "cut").distinct().agg(F.coalesce(F.sum("cut"), F.lit(0))).first()[0]
    known = states.groupBy("value").agg(F.sum("n").alias("low"), F.sum("cut").alias("own"))
    return known.select("value", "low", (F.col("low") + F.lit(slack) - F.col("own")).alias("high")), slack


def top(spark: SparkSession, path: str, plays: DataFrame, column: str, days: str, n: int = 5,
        name: str = "streams") -> DataFrame:
    """The ``n`` most frequent values of the days that satisfy ``days`` (a predicate on the
    column day), ties to the smaller value, null last.  ``plays`` is the stored fact with its
    column day; of it are read the candidates, or nothing, or all (see above)."""
    states = spark.read.schema(STATE).parquet(path).filter(days)
    known, slack = bounds(states)
    if slack == 0:
        counts = known.select("value", F.col("low").alias(name))
    else:
        best = known.orderBy(F.col("low").desc()).limit(n).agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("found")).first()
        rows = plays.filter(days).select(F.col(column).cast("string").alias("value"))
        if best["found"] == n and slack < best["least"]:
            able = known.filter(F.col("high") >= F.lit(best["least"])).select(F.col("value").alias("able"))
            rows = rows.join(able, rows["value"].eqNullSafe(able["able"]), "left_semi")
        counts = rows.groupBy("value").agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), F.col("value").asc_nulls_last()).limit(n).select(F.col("value").alias(column), name)
