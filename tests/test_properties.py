"""Property tests (hypothesis) on small random frames: the operators agree
with brute-force pandas/Python definitions, and do not depend on partitioning."""

import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import sinks as K
from strata.operators.dedup import first_by_key, last_by_key
from strata.operators.joins import lookup_join
from strata.plans import toxicity as T

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 3))
rows_kvo = st.lists(st.tuples(keys, st.integers(0, 9)), min_size=0, max_size=40)


def _frame(spark, data):
    # unique order column = position, so first/last are well defined
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k int, v int, o int")


@SETTINGS
@given(data=rows_kvo, parts=st.integers(1, 6))
def test_first_last_match_brute_force(spark, data, parts):
    df = _frame(spark, data).repartition(parts)
    first, last = {}, {}
    for i, (k, v) in enumerate(data):
        first.setdefault(k, (v, i))
        last[k] = (v, i)
    got_f = {r.k: (r.v, r.o) for r in first_by_key(df, ["k"], ["o"]).collect()}
    got_l = {r.k: (r.v, r.o) for r in last_by_key(df, ["k"], ["o"]).collect()}
    assert got_f == first and got_l == last


@SETTINGS
@given(left=st.lists(st.tuples(keys, st.integers(0, 5)), max_size=30),
       dim=st.lists(st.tuples(keys, st.integers(0, 99)), max_size=30))
def test_lookup_join_keeps_row_count(spark, left, dim):
    l_df = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(left)], "id int, k int")
    d_df = spark.createDataFrame(dim, "dk int, val int")
    out = lookup_join(l_df, d_df, ["k"], ["dk"], ["val"], ["val"])
    assert out.count() == len(left)
    best = {}
    for k, v in dim:
        if k is not None:
            best[k] = min(v, best.get(k, v))
    assert {r.id: r.val for r in out.collect()} == {i: best.get(k) for i, (k, _) in enumerate(left)}


@SETTINGS
@given(a=rows_kvo, b=rows_kvo)
def test_incremental_load_is_idempotent(spark, a, b):
    path = tempfile.mkdtemp(prefix="prop-inc-") + "/t"
    da = spark.createDataFrame(a, "k int, v int") if a else spark.createDataFrame([], "k int, v int")
    db = spark.createDataFrame(b, "k int, v int") if b else spark.createDataFrame([], "k int, v int")
    K.incremental_load(spark, da, path, ["k"])
    K.incremental_load(spark, da, path, ["k"])
    K.incremental_load(spark, db, path, ["k"])
    got = sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=repr)
    seen = {k for k, _ in a}
    want = sorted(list(a) + [(k, v) for k, v in b if k not in seen], key=repr)
    assert got == want


words = st.sampled_from(["gg", "ez", "noob", "hello", "wp", None, "idiot x", "nice"])


@SETTINGS
@given(chat=st.lists(st.tuples(st.integers(0, 4), words, st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                     max_size=40))
def test_summary_forms_agree(spark, chat):
    c = spark.createDataFrame(chat, "match_id long, chat string, player_name string") if chat else \
        spark.createDataFrame([], "match_id long, chat string, player_name string")
    m = spark.range(5).select(F.col("id").alias("match_id"), F.lit("2024-01-01").cast("date").alias("match_date"),
                              (F.col("id") % 3).cast("int").alias("cluster_id"))
    r = spark.createDataFrame([(0, "EU"), (1, "US")], "cluster_id int, region string")
    a = sorted(tuple(x) for x in T.match_summary(c, m, r).collect())
    b = sorted(tuple(x) for x in T.match_summary_direct(c, m, r).collect())
    assert a == b
