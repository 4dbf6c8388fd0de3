"""One key holding a third of all rows: results stay whole and correct, the
shuffle sees that key pre-aggregated, and a partitioned write splits it."""

import os
import tempfile

from pyspark.sql import functions as F

from strata import sinks as K
from strata.operators.dedup import first_by_key, first_row_last_columns, last_by_key
from strata.operators.joins import lookup_join
from strata.plans import toxicity as T

N = 6000
HOT = 7


def _skewed(spark):
    """k = HOT for every third row, else one of 500 cold keys; o is a unique order."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 500 + 1000).alias("k"),
        (F.col("id") * 7 % 101).alias("v"),
        F.col("id").alias("o"),
    ).repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_one_row_policies_combine_before_the_shuffle(spark):
    df = _skewed(spark)
    for out in (first_by_key(df, ["k"], ["o"]), last_by_key(df, ["k"], ["o"])):
        p = _plan(out)
        # one row per key and task crosses the shuffle, and no struct is aggregated
        assert p.count("WindowGroupLimit") == 2 and "SortAggregate" not in p
        assert p.rindex("WindowGroupLimit") > p.index("Exchange hashpartitioning")
    p = _plan(first_row_last_columns(df, ["k"], ["o"], ["v"]))
    assert "partial_min_by" in p or "partial_max_by" in p
    hot_first = first_by_key(df, ["k"], ["o"]).filter(F.col("k") == HOT).first()
    hot_last = last_by_key(df, ["k"], ["o"]).filter(F.col("k") == HOT).first()
    assert (hot_first.o, hot_last.o) == (0, max(i for i in range(N) if i % 3 == 0))


def test_lookup_join_with_hot_key_keeps_every_row(spark):
    left = _skewed(spark)
    dim = spark.range(2000).select((F.col("id") % 1000 + 500).alias("dk"), F.col("id").alias("val"))
    out = lookup_join(left, dim, ["k"], ["dk"], ["val"], ["val"])
    assert out.count() == N
    assert out.filter(F.col("k") == HOT).select("val").distinct().collect()[0].val is None


def test_summary_of_a_hot_match_equals_join_first_form(spark):
    ids = spark.range(N)
    chat = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 40 + 2).cast("long").alias("match_id"),
        F.when(F.col("id") % 17 == 0, F.lit("ez game")).otherwise(F.lit("gg")).alias("chat"),
        (F.col("id") % 10).cast("short").alias("slot"), F.col("id").cast("int").alias("time_in_seconds"),
        F.concat(F.lit("p"), (F.col("id") % 10).cast("string")).alias("player_name"),
        F.lit(None).cast("timestamp").alias("date_processed"))
    matches = spark.range(1, 45).select(F.col("id").alias("match_id"),
                                        F.lit("2024-01-01").cast("date").alias("match_date"),
                                        (F.col("id") % 5).cast("int").alias("cluster_id"))
    regions = spark.range(5).select(F.col("id").cast("int").alias("cluster_id"),
                                    F.concat(F.lit("R"), F.col("id").cast("string")).alias("region"))
    fast = T.match_summary(chat, matches, regions)
    slow = T.match_summary_direct(chat, matches, regions)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    # every exchange of chat rows sits above a partial aggregate
    p = _plan(fast)
    assert p.count("partial_count") >= 1


def test_rebalanced_partitioned_write_splits_a_hot_value(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20 + 1).alias("part"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    path = tempfile.mkdtemp(prefix="skew-write-") + "/t"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        assert K.write_parquet(df, path, "overwrite", ["part"]) == 60000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda v: [f for f in os.listdir(f"{path}/part={v}") if f.endswith(".parquet")]
    assert len(files(0)) > 1  # the hot value is written by several tasks
    assert spark.read.parquet(path).count() == 60000
