from pyspark.sql import functions as F

from strata.operators.dedup import first_by_key, first_row_last_columns, last_by_key, top_per_group
from strata.operators.joins import having_match, lookup_join, missing_keys
from conftest import rows

DATA = [(1, "a", 10), (1, "b", 5), (1, "c", 7), (2, "x", 1), (None, "n1", 3), (None, "n2", 2), (3, None, 9)]
SCHEMA = "k int, v string, o int"


def test_first_and_last_by_key(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(first_by_key(df, ["k"], ["o"])) == rows(spark.createDataFrame(
        [(1, "b", 5), (2, "x", 1), (None, "n2", 2), (3, None, 9)], SCHEMA))
    assert rows(last_by_key(df, ["k"], ["o"])) == rows(spark.createDataFrame(
        [(1, "a", 10), (2, "x", 1), (None, "n1", 3), (3, None, 9)], SCHEMA))


def test_dedup_independent_of_partitioning(spark):
    df = spark.createDataFrame(DATA * 3, SCHEMA).withColumn("o", F.col("o") * 10 + F.monotonically_increasing_id() % 3)
    base = rows(first_by_key(df.coalesce(1), ["k"], ["o", "v"]))
    for n in (2, 5, 11):
        assert rows(first_by_key(df.repartition(n), ["k"], ["o", "v"])) == base


def test_first_row_last_columns(spark):
    df = spark.createDataFrame([(7, "Ann", "F", "free", 1), (7, "Anne", "F", "paid", 2),
                                (7, "X", "F", "free", 3), (8, "Bo", "M", "paid", 1)],
                               "user_id int, name string, gender string, level string, ts int")
    got = first_row_last_columns(df, ["user_id"], ["ts"], ["level"]).drop("ts")
    assert rows(got) == [(7, "Ann", "F", "free"), (8, "Bo", "M", "paid")]


def test_top_per_group(spark):
    df = spark.createDataFrame(DATA, SCHEMA).filter(F.col("k").isNotNull())
    got = top_per_group(df, ["k"], [F.col("o").desc()], n=2)
    assert rows(got) == [(1, "a", 10), (1, "c", 7), (2, "x", 1), (3, None, 9)]


def test_lookup_join_never_fans_out(spark):
    left = spark.createDataFrame([(1, "t1", 1.5), (2, "t1", 1.5), (3, "t2", 9.0), (4, None, 1.0)],
                                 "id int, title string, d double")
    dim = spark.createDataFrame([("t1", 1.5, "S2"), ("t1", 1.5, "S1"), ("t3", 2.0, "S3")],
                                "title string, duration double, song_id string")
    got = lookup_join(left, dim, ["title", "d"], ["title", "duration"], ["song_id"], ["song_id"])
    assert got.count() == left.count()
    assert rows(got, "id", "song_id") == [(1, "S1"), (2, "S1"), (3, None), (4, None)]


def test_anti_and_semi_partition_rows(spark):
    src = spark.createDataFrame([(1,), (2,), (2,), (None,), (5,)], "k int")
    tgt = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    # Null keys never match, so they count as missing.
    assert rows(missing_keys(src, tgt, "k")) == [(1,), (5,), (None,)]
    semi = having_match(src, tgt, "k")
    anti = src.join(tgt, "k", "left_anti")
    assert semi.count() + anti.count() == src.count()


def test_semi_join_makes_its_keys_distinct_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
        plan = having_match(spark.range(5).toDF("k"), hot, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("HashAggregate(keys=[k") == 2 and "LeftSemi" in plan
