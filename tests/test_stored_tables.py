"""Bucketed upserts, compaction, Bloom-filter lookups and the fact by day."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from conftest import rows
from strata import sinks as K
from strata.plans import lookups as L
from strata.plans import stored_fact as SF

USERS = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("level", StringType())])


def batch(spark, values):
    return spark.createDataFrame(values, "id int, name string, level string, ts int")


def files(root):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def scanned(df):
    """Rows that the scans of an executed plan without exchanges put out."""
    df.collect()
    leaves, n = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        n += leaves.apply(i).metrics().apply("numOutputRows").value()
    return n


def test_upserts_equal_row_by_row(spark, tmp_path):
    rng, state = random.Random(1), {}
    t = K.KeyedTable(str(tmp_path / "u"), USERS, ("id",), 8)
    for b in range(4):
        got = [(rng.choice([None, *range(30)]), f"n{b}{i}", rng.choice(["free", "paid", None]), i) for i in range(25)]
        for k, name, level, _ in got:
            state[k] = (state.get(k, (name,))[0], level)
        for _ in range(2 if b == 3 else 1):   # the last batch twice
            t.upsert(spark, batch(spark, got), ["ts"], ["level"])
        assert rows(t.read(spark)) == sorted([(k, *v) for k, v in state.items()], key=repr)
    assert rows(t.lookup(spark, id=3)) == [(3, *state[3])] and rows(t.lookup(spark, id=None)) == [(None, *state[None])]
    assert "PartitionFilters: [isnotnull(bucket_of_8" in t.lookup(spark, id=3)._jdf.queryExecution().executedPlan().toString()


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    t = K.KeyedTable(str(tmp_path / "u"), USERS, ("id",), 16)
    t.upsert(spark, batch(spark, [(i, "a", "free", 0) for i in range(400)]), ["ts"], ["level"])
    before = files(t.path)
    t.upsert(spark, batch(spark, [(5, "b", "paid", 0)]), ["ts"], ["level"])
    after = files(t.path)
    assert len({os.path.dirname(f) for f, _ in set(before.items()) - set(after.items())}) == 1
    assert rows(t.read(spark).filter("level = 'paid'")) == [(5, "a", "paid")] and t.read(spark).count() == 400


def test_a_table_is_opened_with_its_own_number_of_buckets(spark, tmp_path):
    path = str(tmp_path / "u")
    K.KeyedTable(path, USERS, ("id",), 8).upsert(spark, batch(spark, [(1, "a", "x", 0)]), ["ts"], ["level"])
    with pytest.raises(ValueError, match="bucket_of_8"):
        K.KeyedTable(path, USERS, ("id",), 4).read(spark)
    with pytest.raises(ValueError):
        K.KeyedTable(path, USERS, ("id",), 8).lookup(spark, name="a")


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    t = K.KeyedTable(str(tmp_path / "u"), USERS, ("id",), 8)
    t.upsert(spark, batch(spark, [(1, "a", "x", 0)]), ["ts"], ["level"])
    before = files(t.path)
    assert t.upsert(spark, batch(spark, []), ["ts"], ["level"]) == 0
    assert files(t.path) == before


PAIR = StructType([StructField("v", LongType()), StructField("a", IntegerType()), StructField("b", StringType())])


def test_compaction_keeps_rows_and_leaves_large_and_single_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(10):
        df = spark.range(i * 10, i * 10 + 10).select(F.col("id").alias("v"), F.when(F.lit(i != 3), F.lit(i % 2)).alias("a"),
                                                     F.lit("x" if i < 8 else None).cast("string").alias("b"))
        K.write_parquet(df, path, "append", ["a", "b"])
    before, want = files(path), rows(spark.read.schema(PAIR).parquet(path))
    lone = [f for f in before if "a=__HIVE" in f]
    assert len(before) == 10 and len(lone) == 1
    assert K.compact(spark, path, PAIR, ["a", "b"]) == 70    # (0, x) and (1, x); the others hold one file
    after = files(path)
    assert len(after) == 5 and before[lone[0]] == after[lone[0]]
    assert rows(spark.read.schema(PAIR).parquet(path)) == want
    assert K.compact(spark, path, PAIR, ["a", "b"]) == 0 and files(path) == after
    assert K.compact(spark, path, PAIR, ["a", "b"], target_bytes=10) == 0


def test_compaction_of_an_unpartitioned_and_of_an_empty_table(spark, tmp_path):
    path, one = str(tmp_path / "t"), StructType(PAIR.fields[:1])
    for i in range(4):
        K.write_parquet(spark.range(i, i + 3).select(F.col("id").alias("v")).coalesce(1), path, "append")
    want = rows(spark.read.schema(one).parquet(path))
    assert K.compact(spark, path, one, sort_within=["v"]) == 12
    assert len(files(path)) == 1 and rows(spark.read.schema(one).parquet(path)) == want
    empty = str(tmp_path / "e")
    K.write_parquet(spark.range(0).select(F.col("id").alias("v")), empty)
    assert K.compact(spark, empty, one) == 0


def test_lookup_reads_only_row_groups_that_may_hold_the_key(spark, tmp_path):
    n = 40_000   # every file holds keys from the whole range, so min and max tell nothing
    table = spark.range(n, numPartitions=1).select(F.concat(F.lit("song "), F.md5(F.col("id").cast("string"))).alias("song"), F.col("id").cast("string").alias("user")) \
        .repartition(8, "user")
    plain, bloom = str(tmp_path / "p"), str(tmp_path / "b")
    K.write_parquet(table, plain)
    L.store_lookup(table, bloom, ["song"], 10_000)
    key = table.filter("user = '123'").first()["song"]

    def look(path, song):
        return L.song_listener_lookup(spark.read.schema(table.schema).parquet(path), song)

    assert rows(look(bloom, key)) == [("123",)]
    assert scanned(look(plain, key)) > 0.9 * n
    assert 0 < scanned(look(bloom, key)) < 0.3 * n
    assert scanned(look(bloom, "song 8 of nobody")) < 0.3 * n


FACT = "start_time timestamp, user_id long, location string"


def test_questions_prune_the_stored_fact_by_the_day_dimension(spark, tmp_path):
    rng = random.Random(3)
    data = [(dt.datetime(2024, rng.randint(1, 3), rng.randint(1, 28), rng.randint(0, 23), tzinfo=dt.timezone.utc),
             rng.choice([None, *range(9)]), "x") for _ in range(500)] + [(None, 1, "y")]
    fact = spark.createDataFrame(data, FACT)
    path, days = str(tmp_path / "f"), str(tmp_path / "d")
    assert SF.add_plays(fact.limit(200), path) + SF.add_plays(fact.exceptAll(fact.limit(200)), path) == 501
    schema = SF.fact_schema(fact)
    SF.write_days(spark, path, schema, days)
    for where, keep in (("year = 2024 AND month = 2", F.month("start_time") == 2), ("weekday = 2", F.dayofweek("start_time") == 2),
                        ("year = 1999", F.lit(False))):
        got = SF.plays_of(spark, path, schema, days, where)
        assert rows(got) == rows(fact.filter(keep))
    got = SF.plays_of(spark, path, schema, days, "year = 2024 AND month = 2")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
