"""Most frequent values from daily states against counting the fact."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.plans import top_states as TS

FACT = "start_time timestamp, location string, day date"


def plays(spark, seed, weights, n=600):
    rng, out = random.Random(seed), []
    for _ in range(n):
        day = dt.date(2024, 1, rng.randint(1, 9))
        place = rng.choices(list(weights), list(weights.values()))[0]
        out.append((dt.datetime(day.year, day.month, day.day, rng.randint(0, 23), tzinfo=dt.timezone.utc), place, day))
    return spark.createDataFrame(out, FACT)


def recount(fact, days, n):
    c = fact.filter(days).groupBy("location").agg(F.count(F.lit(1)).alias("streams"))
    return [tuple(r) for r in c.orderBy(F.col("streams").desc(), F.col("location").asc_nulls_last()).limit(n).collect()]


HOT = {"a": 300, "b": 200, None: 150, "c": 40, **{f"x{i}": 1 for i in range(40)}}
EVEN = {f"x{i}": 1 for i in range(40)}


def check(spark, tmp_path, weights, keep, n, reads):
    path = str(tmp_path / f"s{keep}")
    loads = [plays(spark, s, weights) for s in (1, 2)]
    for part in loads:
        TS.add_days(part, path, "location", keep)
    fact = loads[0].unionByName(loads[1])
    for days in ("day < DATE '2024-01-05'", "dayofweek(day) = 2", "true"):
        got = TS.top(spark, path, fact, "location", days, n)
        assert [tuple(r) for r in got.collect()] == recount(fact, days, n)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert {"nothing": "ExistingRDD" not in plan and "LogicalRDD" not in plan,
            "candidates": "LeftSemi" in plan, "all": "LogicalRDD" in plan and "LeftSemi" not in plan}[reads]


def test_states_that_list_all_values_need_no_fact(spark, tmp_path):
    check(spark, tmp_path, HOT, 50, 4, "nothing")


def test_candidates_alone_are_counted_again(spark, tmp_path):
    check(spark, tmp_path, HOT, 6, 3, "candidates")


def test_all_are_counted_where_the_bound_does_not_hold(spark, tmp_path):
    check(spark, tmp_path, EVEN, 2, 5, "all")


def test_ties_few_values_and_no_plays(spark, tmp_path):
    check(spark, tmp_path, {"a": 1, "b": 1}, 1, 5, "all")
    empty, path = plays(spark, 1, EVEN, 5).limit(0), str(tmp_path / "none")
    TS.add_days(empty, path, "location")
    assert TS.top(spark, path, empty, "location", "true").collect() == []
