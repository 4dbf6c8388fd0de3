import os
import time

import pytest
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from strata import schemas as SC
from strata import session as S
from strata import sinks as K
from strata.sources import files as FL
from strata.streaming import stream_incremental_load
from conftest import rows


def test_incremental_load_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, v string")
    assert K.incremental_load(spark, a, path, ["k"]) == 3
    assert K.incremental_load(spark, a, path, ["k"]) == 0       # twice == once, null key included
    b = spark.createDataFrame([(2, "late"), (3, "z")], "k int, v string")
    assert K.incremental_load(spark, b, path, ["k"]) == 1        # only the new key
    assert rows(spark.read.parquet(path)) == rows(a.union(b.filter("k = 3")))


def test_incremental_refresh_overwrites_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x", "d1"), (2, "y", "d2")], "k int, v string, p string")
    K.incremental_load(spark, a, path, ["k"], ["p"])
    b = spark.createDataFrame([(1, "x2", "d1"), (5, "z", "d1")], "k int, v string, p string")
    K.incremental_load(spark, b, path, ["k"], ["p"], refresh=True)
    assert rows(spark.read.parquet(path), "k", "v", "p") == [(1, "x2", "d1"), (2, "y", "d2"), (5, "z", "d1")]


def test_append_if_absent_first_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    K.append_if_absent(spark, spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "k int, v string, o int"),
                       path, ["k"], ["o"])
    K.append_if_absent(spark, spark.createDataFrame([(1, "c", 0), (2, "d", 5)], "k int, v string, o int"),
                       path, ["k"], ["o"])
    assert rows(spark.read.parquet(path)) == [(1, "b"), (2, "d")]


def test_upsert_columns_batches_equal_whole(spark, tmp_path):
    data = [(7, "Ann", "free", 1), (7, "Anne", "paid", 2), (8, "Bo", "free", 3), (7, "Z", "free", 4)]
    df = spark.createDataFrame(data, "user_id int, name string, level string, ts int")
    p1, p2 = str(tmp_path / "a"), str(tmp_path / "b")
    K.upsert_columns(spark, df, p1, ["user_id"], ["ts"], ["level"])
    K.upsert_columns(spark, df.filter("ts <= 2"), p2, ["user_id"], ["ts"], ["level"])
    K.upsert_columns(spark, df.filter("ts > 2"), p2, ["user_id"], ["ts"], ["level"])
    want = [(7, "Ann", "free"), (8, "Bo", "free")]
    assert rows(spark.read.parquet(p1)) == want
    assert rows(spark.read.parquet(p2)) == want


def test_overwrite_replaces_the_partitions_of_the_first_write(spark, tmp_path):
    path = str(tmp_path / "t")
    songs = spark.createDataFrame([("S1", 2000), ("S2", 2001)], "song string, year int")
    K.load_table(songs, path, append=False, partition_by=["year"])
    K.load_table(spark.createDataFrame([("S1", 1999)], "song string, year int"), path, append=False, partition_by=["year"])
    assert rows(spark.read.parquet(path)) == [("S1", 1999)]
    K.write_parquet(songs, path, "overwrite", ["year"], replace="partitions")
    assert rows(spark.read.parquet(path)) == [("S1", 1999), ("S1", 2000), ("S2", 2001)]


@pytest.mark.parametrize("zone", ["America/New_York", "Australia/Lord_Howe", "UTC"])
def test_bounds_hold_in_the_hour_that_a_clock_change_repeats(spark, tmp_path, monkeypatch, zone):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        path = str(tmp_path / "t")
        for us in (1730611800000000, 1730615400000000):  # 05:30Z and 06:30Z: both 01:30 in New York
            one = spark.range(1).select(F.timestamp_micros(F.lit(us)).alias("start_time"), F.lit(1).alias("o"))
            for _ in range(2):
                K.append_if_absent(spark, one, path, ["start_time"], ["o"], range_by=["start_time"])
        assert spark.read.parquet(path).count() == 2
        part = spark.read.parquet(path)
        assert part.where(K.touched_partitions(part, ["start_time"])).count() == 2
    finally:
        monkeypatch.undo()
        time.tzset()


def test_create_insert_and_drop_table(spark, tmp_path):
    name = S.scratch_table(spark, "t")
    K.create_table(spark, name, SC.REGION, str(tmp_path / "t"))
    K.create_table(spark, name, SC.REGION)
    assert spark.catalog.tableExists(name) and spark.table(name).schema == SC.REGION
    K.drop_table(spark, name)
    K.drop_table(spark, name)  # a second drop is a no-op
    assert not spark.catalog.tableExists(name)


def test_single_file_only_within_its_bound(spark, tmp_path):
    files = lambda p: [f for f in os.listdir(p) if f.endswith(".parquet")]
    df = spark.range(0, 100, 1, 5)
    assert K.single_file_overwrite(df, str(tmp_path / "a")) == 100 and len(files(tmp_path / "a")) == 1
    assert K.single_file_overwrite(df, str(tmp_path / "b"), max_rows=99) == 100 and len(files(tmp_path / "b")) == 5


def test_scratch_is_dropped_and_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    path = S.shared_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert FL.path_exists(spark, path)
    S.drop_scratch(spark)
    assert not FL.path_exists(spark, path)

    class Cluster:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda k, d=None: None)}))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_base(type("Session", (), {"sparkContext": Cluster}))


def test_a_rewritten_table_is_read_under_its_own_schema(spark, tmp_path):
    from strata.sources import views as V
    p = str(tmp_path / "part.parquet")
    spark.range(2).write.parquet(p)
    assert V.read_table(spark, str(tmp_path), "part").columns == ["id"]
    time.sleep(1.1)
    spark.range(2).select(F.col("id").alias("other")).write.mode("overwrite").parquet(p)
    assert V.read_table(spark, str(tmp_path), "part").columns == ["other"]


# ---- CSV by header name ------------------------------------------------------

REGION_CSV = SC.REGION_CSV


def _csv(tmp_path, name, *lines):
    d = tmp_path / "csv"
    d.mkdir(exist_ok=True)
    (d / name).write_text("\n".join(lines) + "\n")
    return str(d)


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    src = _csv(tmp_path, "a.csv", "region,extra,cluster", "EU,x,1", "US,y,2")
    assert rows(FL.read_csv(spark, src, REGION_CSV)) == [(1, "EU"), (2, "US")]


def test_csv_without_a_needed_column_or_with_two_headers_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="cluster"):
        FL.read_csv(spark, _csv(tmp_path, "a.csv", "region,number", "EU,1"), REGION_CSV)
    src = _csv(tmp_path, "a.csv", "region,cluster", "EU,1")
    _csv(tmp_path, "b.csv", "cluster,region", "2,US")
    with pytest.raises(Exception, match="(?i)header"):
        FL.read_csv(spark, src, REGION_CSV).collect()


def test_csv_bad_fields_are_counted_and_follow_the_policy(spark, tmp_path):
    src = _csv(tmp_path, "a.csv", "cluster,region", "1,EU", "x,US", ",AS", "99999999999,SA", " 7 ,AF")
    assert rows(FL.read_csv(spark, src, REGION_CSV)) == sorted(
        [(1, "EU"), (None, "US"), (None, "AS"), (None, "SA"), (7, "AF")], key=repr)
    assert rows(FL.read_csv(spark, src, REGION_CSV, on_bad="drop")) == sorted([(1, "EU"), (None, "AS"), (7, "AF")], key=repr)
    text = FL.csv_text(spark, src, REGION_CSV)
    assert rows(FL.csv_rejects(text, REGION_CSV)) == [(5, 2, 2)]
    with pytest.raises(ValueError):
        FL.read_csv(spark, src, REGION_CSV, on_bad="ignore")


def test_inferred_types_and_drift(spark, tmp_path):
    src = _csv(tmp_path, "drift.csv", "cluster,a,b,c,d,e,f,odd.name", "1,3000000000,1.5,2024-01-02,2024-01-02 03:04:05,true,,x",
               "2,1,2,2024-1-3,2024-01-02,FALSE,,y", " ,-4,x,,,,,1")
    types = {r["column_name"]: (r["filled"], r["inferred"]) for r in FL.inferred_types(spark.read.option("header", True).csv(src)).collect()}
    assert types == {"cluster": (2, "int"), "a": (3, "bigint"), "b": (3, "string"), "c": (2, "date"), "d": (2, "timestamp"),
                     "e": (2, "boolean"), "f": (0, None), "odd.name": (3, "string")}
    df = FL.read_csv_inferred(spark, src)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "bigint", "string", "date", "timestamp", "boolean", "string", "string"]
    assert [(r["cluster"], r["a"], r["e"]) for r in df.collect()] == [(1, 3000000000, True), (2, 1, False), (None, -4, None)]
    drift = {r["column_name"]: tuple(r)[1:] for r in FL.schema_drift(spark, src, StructType.fromDDL("cluster int, a int, region string")).collect()}
    assert drift["cluster"] == ("int", "int", 2, 0, "fits")
    assert drift["a"] == ("int", "bigint", 3, 1, "misfits")
    assert drift["region"] == ("string", None, None, None, "missing")
    assert drift["b"] == (None, "string", 3, None, "extra")
    assert len(drift) == 9


def test_csv_without_header_is_read_by_position(spark, tmp_path):
    src = _csv(tmp_path, "a.csv", "1,EU", "2,US")
    assert rows(FL.read_csv(spark, src, REGION_CSV, header=False)) == [(1, "EU"), (2, "US")]


def test_quoted_csv_export(spark, tmp_path):
    path = str(tmp_path / "csv")
    K.export_csv_quoted(spark.createDataFrame([("a", 1)], "s string, n int"), path, single_file=True)
    part = [f for f in os.listdir(path) if f.endswith(".csv")][0]
    assert open(os.path.join(path, part)).read().splitlines() == ['"s","n"', '"a","1"']


def test_json_recursive_and_stage(spark, tmp_path):
    root = str(tmp_path / "log")
    df = spark.createDataFrame([(1, "NextSong", 5), (2, "Home", 6)], "event_id long, page string, day int")
    df.write.partitionBy("day").json(root + "/2018/11")
    open(root + "/2018/11/README.txt", "w").write("not json")
    n = FL.stage_json(spark, "{r}/{y}/{m}", SC.EVENT_JSON, str(tmp_path / "staged"), r=root, y="2018", m="11")
    assert n == 2
    assert rows(spark.read.parquet(str(tmp_path / "staged")), "event_id", "page") == [(1, "NextSong"), (2, "Home")]


def test_stream_load_only_new_files(spark, tmp_path):
    src, tgt, ck = str(tmp_path / "src"), str(tmp_path / "tgt"), str(tmp_path / "ck")
    os.makedirs(src)
    spark.createDataFrame([(1, "hi"), (2, "yo")], "match_id long, key string").write.mode("append") \
        .option("header", "true").csv(src)
    schema = "match_id long, key string"
    from pyspark.sql.types import StructType
    st = StructType.fromDDL(schema)
    n1 = stream_incremental_load(spark, src, "csv", st, tgt, ["match_id"], ck, options={"header": "true"})
    n2 = stream_incremental_load(spark, src, "csv", st, tgt, ["match_id"], ck, options={"header": "true"})
    spark.createDataFrame([(2, "again"), (3, "new")], schema).write.mode("append").option("header", "true").csv(src)
    n3 = stream_incremental_load(spark, src, "csv", st, tgt, ["match_id"], ck, options={"header": "true"})
    assert (n1, n2, n3) == (2, 0, 1)
    assert rows(spark.read.parquet(tgt)) == [(1, "hi"), (2, "yo"), (3, "new")]


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    a = spark.range(1000).select((F.col("id") % 10).cast("string").alias("artist_id"), F.col("id").alias("t"))
    b = spark.range(10).select(F.col("id").cast("string").alias("artist_id"), F.lit("n").alias("name"))
    K.bucketed_table(a, "fact_bk_test", str(tmp_path / "f"), 4, ["artist_id"], ["t"])
    K.bucketed_table(b, "art_bk_test", str(tmp_path / "a"), 4, ["artist_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("fact_bk_test").join(spark.table("art_bk_test"), "artist_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert j.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prune_by_reads_only_touched_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "t")
    old = spark.range(10000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("p"))
    K.write_parquet(old, path, "overwrite", ["p"])
    new = spark.range(10000, 10100).select(F.col("id").alias("k"), F.lit(3).cast("long").alias("p")) \
        .unionByName(spark.range(5).select((F.col("id") * 10).alias("k"), F.lit(0).cast("long").alias("p")))
    todo = K.rows_not_in_target(spark, new, path, ["k"], prune_by=["p"])
    assert sorted(r.k for r in todo.collect()) == list(range(10000, 10100))
    # the target scan read 2 of the 10 partition directories
    def part_counts(p):
        out = []
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return part_counts(p.executedPlan())
        if kind.endswith("QueryStageExec"):
            return part_counts(p.plan())
        if "Scan" in p.nodeName() and p.metrics().contains("numPartitions"):
            out.append(p.metrics().apply("numPartitions").value())
        ch = p.children()
        for i in range(ch.size()):
            out += part_counts(ch.apply(i))
        return out
    counts = part_counts(todo._jdf.queryExecution().executedPlan())
    assert counts and max(counts) == 2


def test_range_by_skips_older_row_groups(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "t")
    old = spark.range(0, 20000, 1, 4).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    K.write_parquet(old, path, "overwrite", sort_within=["k"])
    new = spark.range(30000, 30100).select(F.col("id").alias("k"), F.lit("y").alias("v")) \
        .unionByName(spark.range(5).select((F.col("id") * 1000).alias("k"), F.lit("x").alias("v")))
    todo = K.rows_not_in_target(spark, new, path, ["k", "v"], range_by=["k"])
    assert sorted(r.k for r in todo.collect()) == list(range(30000, 30100))
    # A batch of only new keys: the stored rows are read through the range
    # filter, which parquet applies to row-group statistics -- nothing is read.
    only_new = new.filter("k >= 30000")
    assert K.rows_not_in_target(spark, only_new, path, ["k", "v"], range_by=["k"]).count() == 100
    stored = spark.read.parquet(path).where(K.key_ranges(only_new, ["k"], keep_nulls=True)).select("k")
    assert stored.collect() == []
    scan = stored._jdf.queryExecution().executedPlan()
    while "Scan" not in scan.nodeName():
        kind = scan.getClass().getSimpleName()
        scan = scan.executedPlan() if kind == "AdaptiveSparkPlanExec" else scan.children().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 0


def test_pruned_load_is_exact_with_null_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(100).select(F.col("id").alias("k"),
                                  F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("p"))
    K.write_parquet(old, path, "overwrite", ["p"])
    # new: every old row again (same key -> same partition) plus 10 new keys in a null partition
    new = old.unionByName(spark.range(100, 110).select(F.col("id").alias("k"), F.lit(None).cast("long").alias("p")))
    want = list(range(100, 110))
    assert sorted(r.k for r in K.rows_not_in_target(spark, new, path, ["k"], prune_by=["p"]).collect()) == want


def test_listing_many_directories_takes_one_task_a_core(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(60).withColumn("k", F.col("id")).coalesce(1).write.partitionBy("k").parquet(path)
    S.configure(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        df = spark.read.schema("id long, k long").parquet(path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and sum(s.numTasks for s in stages) <= spark.sparkContext.defaultParallelism
    assert df.filter("id = k").count() == 60
