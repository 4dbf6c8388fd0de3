"""Plan-shape checks on the registered queries."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF001
from strata import session as S
from strata.sources import views as V


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["match_summary", "toxic_kpis", "toxic_word_hits", "chat_message_flags"])
def test_no_python_in_hot_path(spark, name):
    p = _plan(E.queries()[name](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def _own():
    """The queries of the reference's operators."""
    return {n: f for n, f in E.queries().items() if not re.match(r"op\d+_|pipeline$", n)}


def test_no_cartesian_and_no_python_anywhere(spark):
    for name, fn in _own().items():
        p = _plan(fn(spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        assert not re.search("InPandas|InArrow|EvalPython", p), name
    assert S.drop_scratch(spark) > 0


def test_building_a_plan_runs_no_shuffle(spark):
    """Only schema reads (one stage each, no exchange) happen before the action."""
    tracker = spark.sparkContext.statusTracker()
    for name in ("staging", "songplays_lookup", "match_summary", "toxic_kpis", "top_artist_per_location", "users_first_last_level"):
        build = (lambda: V.staging_events(spark, SF001)) if name == "staging" else (lambda: E.queries()[name](spark, SF001))
        build()
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        try:
            build()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert list(tracker.getJobIdsForGroup(f"plan-{name}")) == [], name


def test_facts_are_not_aggregated_as_structs(spark):
    for name in ("songplays_lookup", "songplays_unique_start", "session_item_table", "user_session_table"):
        assert "SortAggregate" not in _plan(E.queries()[name](spark, SF001)), name


def test_top_artist_builds_the_fact_once(spark):
    df = E.queries()["top_artist_per_location"](spark, SF001)
    df.collect()
    p = _plan(df)
    assert "ReusedExchange" in p.split("Initial Plan")[0]


def test_kpis_read_only_match_ids_of_the_second_chat_scan(spark):
    p = E.queries()["toxic_kpis"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<conv_id:bigint>" in p


def test_direct_form_uses_group_limit(spark):
    df = E.queries()["match_summary_direct"](spark, SF001)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString() or \
        "WindowGroupLimit" in _plan(df)


def test_filters_reach_the_scan(spark):
    p = _plan(E.queries()["match_summary"](spark, SF001))
    assert "PushedFilters: [IsNotNull(conv_id)]" in p


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["match_id", "match_date", "toxic", "toxic_count", "toxic_player_count", "region"]
    assert df.count() >= 0


def _scan_output_rows(df):
    """Rows emitted by the (single) file scan of an executed plan."""
    def walk(p):
        if "Scan" in p.nodeName() and p.metrics().contains("numOutputRows"):
            return p.metrics().apply("numOutputRows").value()
        ch = p.children()
        for i in range(ch.size()):
            r = walk(ch.apply(i))
            if r is not None:
                return r
        return None
    return walk(df._jdf.queryExecution().executedPlan())


def test_bucketed_point_lookup_reads_one_bucket(spark, tmp_path):
    from pyspark.sql import functions as F
    from strata import sinks as K
    from strata.plans import lookups as L
    src = spark.range(20000).select((F.col("id") % 997).alias("sessionId"), F.floor(F.col("id") / 997).cast("int").alias("itemInSession"),
                                    F.lit("a").alias("artist"), F.lit("s").alias("song"),
                                    F.lit(1.0).alias("length"), F.col("id").alias("ts"), F.col("id").alias("event_id"))
    K.bucketed_table(L.session_items(src), "si_prune_probe", str(tmp_path / "si"), 16, ["session_id"],
                     ["item_in_session"])
    df = L.session_item_lookup(spark.table("si_prune_probe"), 5, 3)
    assert len(df.collect()) == 1
    # bucket pruning: only the files of session 5's bucket are read (about 1/16 of the rows)
    assert _scan_output_rows(df) <= 20000 // 8
