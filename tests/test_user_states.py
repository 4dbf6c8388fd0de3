"""Distinct users from stored daily bitmaps against counting the fact."""

import random

import pytest
from pyspark.sql import functions as F

from strata.plans import analytics as A
from strata.plans import user_states as U

FACT = "start_time timestamp, user_id long"


def plays(spark, n, seed):
    rng = random.Random(seed)
    ids = [None, 0, -1, 32768, 2 ** 45, -2 ** 45] + list(range(1, 60)) + [100_000 + 7 * i for i in range(40)]
    rows = [(f"2024-{rng.randint(1, 3):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:00:00", rng.choice(ids)) for _ in range(n)]
    return spark.createDataFrame(rows, "t string, user_id long").select(F.to_timestamp("t").alias("start_time"), "user_id")


def test_states_equal_a_recount_of_the_fact(spark, tmp_path):
    path, first, late = str(tmp_path / "s"), plays(spark, 400, 1), plays(spark, 200, 2)
    U.add_days(first, path)
    U.add_days(late, path)   # further plays of the same days
    U.add_days(late, path)   # and the same load again
    both = first.unionByName(late)
    for lo, hi in (("2024-01-01", "2024-02-01"), ("2024-02-10", "2024-02-11"), ("2024-01-01", "2025-01-01"), ("2023-01-01", "2023-02-01")):
        got = U.unique_users(spark, path, lo, hi)
        assert got.first()[0] == A.unique_users(both, f"{lo} 00:00:00", f"{hi} 00:00:00").first()[0]
    want = {r["m"]: r["n"] for r in both.groupBy(F.trunc("start_time", "month").alias("m")).agg(F.count_distinct("user_id").alias("n")).collect()}
    assert {r["month"]: r["unique_users"] for r in U.unique_users_by_month(spark, path).collect()} == want


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "s")
    U.add_days(plays(spark, 300, 3), path)
    plan = U.unique_users(spark, path, "2024-02-01", "2024-03-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and path.split("/")[-1] in plan
    with pytest.raises(ValueError):
        U.unique_users(spark, path, "2024-02-01 10:00:00", "2024-03-01")


def test_no_plays(spark, tmp_path):
    path = str(tmp_path / "s")
    U.add_days(spark.createDataFrame([], FACT), path)
    assert U.unique_users(spark, path, "2024-01-01", "2024-02-01").first()[0] == 0
