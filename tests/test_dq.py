from pyspark.sql import functions as F

from strata.operators import dq
from conftest import rows


def test_orphan_check(spark):
    chat = spark.createDataFrame([(1,), (1,), (2,), (9,)], "match_id long")
    matches = spark.createDataFrame([(1,), (2,), (3,)], "match_id long")
    assert rows(dq.orphan_check(chat, matches, "match_id", "match_id", "chat", "match")) == \
        [("chat", "match", 1, "Failed")]
    assert rows(dq.orphan_check(matches.filter("match_id < 3"), chat, "match_id")) == \
        [("source", "target", 0, "Success")]


def test_key_and_null_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "k int, v string")
    assert rows(dq.key_violations(df, ["k"], "t")) == [("t", "k", 1, 2)]
    assert rows(dq.null_violations(df, ["k", "v"], "t")) == [("t", "k", 2), ("t", "v", 1)]


def test_nonempty_gate_tests_the_value(spark):
    empty = spark.createDataFrame([], "a int")
    full = spark.range(3)
    assert rows(dq.nonempty_tables({"e": empty, "f": full})) == [("e", 0, False), ("f", 3, True)]


def test_run_record_counts(spark):
    df = spark.createDataFrame([(1, "r1"), (2, "r2"), (3, "r2")], "a int, run string")
    got = dq.run_record_counts({"x": df, "y": df.filter("a > 5")}, F.col("run") == "r2")
    assert rows(got) == [("x", 2, True), ("y", 0, False)]
