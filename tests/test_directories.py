"""Tables of very many directories: written by the workers, read in split listings."""

import datetime as dt
import glob
import os
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata import schemas as SC
from strata import session as S
from strata import sinks as K
from strata.plans import etl_run as R
from strata.plans.registry import QUERIES
from strata.sinks import directories as D
from strata.sources import files as FL

ODD = ["a", "", None, "a/b:c%d", "x=y", "{z}[0]^", "é ü+", "q?*\\\"'#\t", "__HIVE"]
SONGS = "song_id string, title string, artist_id string, year int, duration double"


def songs(spark, n=120):
    return spark.createDataFrame([(f"S{i}", f"t{i % 7}", ODD[i % len(ODD)], None if i % 11 == 0 else 1990 + i % 5, i / 4)
                                  for i in range(n)], SONGS)


def tree(path):
    return sorted({os.path.relpath(os.path.dirname(f), path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)})


def test_songs_by_pair_are_as_spark_writes_them_without_a_process_each(spark, tmp_path):
    ours, theirs = str(tmp_path / "ours"), str(tmp_path / "theirs")
    df = songs(spark)
    assert R.write_songs(df, ours, ["year", "artist_id"]) == 120
    df.repartition(1).write.partitionBy("year", "artist_id").parquet(theirs)
    assert tree(ours) == tree(theirs)
    assert rows(spark.read.schema(SC.SONGS).parquet(ours)) == rows(spark.read.schema(SC.SONGS).parquet(theirs))
    assert spark.read.parquet(ours).schema == spark.read.parquet(theirs).schema
    # Hadoop's local file system leaves a checksum file beside each file that it made (with a chmod process each)
    assert not glob.glob(f"{ours}/**/.*.crc", recursive=True) and os.path.exists(f"{ours}/_SUCCESS")
    assert os.listdir(tmp_path).count("ours") == 1 and not [f for f in os.listdir(tmp_path) if "__" in f]


def test_roundtrip_query_writes_and_lists_without_the_cost_per_directory(spark):
    df = QUERIES["partitioned_roundtrip"](spark, SF001)
    path = S._SCRATCH[-1].removeprefix("file:")
    years = [y for y in os.listdir(path) if y.startswith("year=")]
    assert len(tree(path)) > len(years) > 1
    assert not glob.glob(f"{path}/**/.*.crc", recursive=True)
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == min(len(years), FL.LISTINGS)
    assert rows(df) == rows(spark.read.schema(SC.SONGS).parquet(path).select(*SC.SONGS.fieldNames()))


def test_rows_of_a_directory_split_over_tasks_all_arrive(spark, tmp_path):
    path, key = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    df = spark.range(60_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"),
                                                     F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 5).alias("k"))
    kept = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        assert K.write_directories(df, path, ["k"], ["k", "id"]) == 60_000
    finally:
        spark.conf.set(key, kept)
    assert len(glob.glob(f"{path}/k=7/*.parquet")) > 1
    assert rows(spark.read.schema(df.schema).parquet(path), "id", "h", "k") == rows(df)


def test_a_directory_is_written_in_bounded_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "ROW_GROUP_BYTES", 50_000)
    path = str(tmp_path / "t")
    df = spark.range(30_000).select("id", F.lit("x").alias("k"))
    assert K.write_directories(df.coalesce(1), path, ["k"]) == 30_000
    files = glob.glob(f"{path}/k=x/*.parquet")
    assert max(pq.ParquetFile(f).num_row_groups for f in files) > 1
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(30_000))


def test_moved_attempts_share_directories(tmp_path):
    for a in ("one", "two"):
        os.makedirs(tmp_path / a / "y=1" / "k=1")
        (tmp_path / a / "y=1" / "k=1" / f"part-{a}.parquet").write_text(a)
    os.makedirs(tmp_path / "two" / "y=2" / "k=1")
    (tmp_path / "two" / "y=2" / "k=1" / "part-two.parquet").write_text("two")
    os.makedirs(tmp_path / "table")
    move = D._mover(str(tmp_path / "table"), 2)
    for a in ("one", "two", "two"):  # a repeated task finds nothing left to move
        move(str(tmp_path / a))
    assert [os.path.relpath(f, tmp_path / "table") for f in sorted(glob.glob(f"{tmp_path}/table/**/*.parquet", recursive=True))] == [
        "y=1/k=1/part-one.parquet", "y=1/k=1/part-two.parquet", "y=2/k=1/part-two.parquet"]


def test_overwrite_replaces_and_a_failed_one_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = songs(spark)
    R.write_songs(df, path, ["year", "artist_id"])
    old = spark.read.schema(SC.SONGS).parquet(path)
    want = rows(old.filter("year = 1991"), *SC.SONGS.fieldNames())
    assert K.write_directories(old.filter("year = 1991"), path, ["year", "artist_id"]) == len(want) > 1
    assert rows(spark.read.schema(SC.SONGS).parquet(path), *SC.SONGS.fieldNames()) == want
    with pytest.raises(Exception, match="stop here"):
        bad = F.when(F.col("song_id") == "S50", F.raise_error(F.lit("stop here"))).otherwise(F.col("title"))
        R.write_songs(df.withColumn("title", bad.cast("string")), path, ["year", "artist_id"])
    assert rows(spark.read.schema(SC.SONGS).parquet(path), *SC.SONGS.fieldNames()) == want
    assert os.listdir(tmp_path) == ["t"]
    assert R.write_songs(df.filter("false"), path, ["year", "artist_id"]) == 0
    assert FL.read_directories(spark, path, SC.SONGS).count() == 0


def test_values_of_every_plain_type_come_back_and_others_keep_sparks_writer(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 2, 29), dt.datetime(2020, 2, 29, 1, 2, 3, 456789), Decimal("1.23"), True, 2.5, "s", "p"),
         (None, None, None, None, None, None, None, None)],
        "i long, d date, t timestamp, m decimal(20,2), b boolean, f float, s string, p string")
    for by in (["p"], ["d", "m"], ["t"], ["b", "i"]):
        path = str(tmp_path / "-".join(by))
        assert K.write_directories(df, path, by) == 2
        assert not glob.glob(f"{path}/**/.*.crc", recursive=True)
        assert rows(spark.read.schema(df.schema).parquet(path), *df.columns) == rows(df)
    nested = df.withColumn("a", F.array("i"))
    assert K.write_directories(nested, str(tmp_path / "nested"), ["p"]) == 2
    assert rows(spark.read.parquet(str(tmp_path / "nested")), "a") == rows(nested, "a")


def test_read_directories_is_one_read_in_parts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = songs(spark, 400).withColumn("year", F.col("duration").cast("int"))
    R.write_songs(df, path, ["year", "artist_id"])
    whole, parts = spark.read.schema(SC.SONGS).parquet(path), FL.read_directories(spark, path, SC.SONGS)
    assert parts.schema == whole.schema and rows(parts) == rows(whole)
    assert parts._jdf.queryExecution().optimizedPlan().collectLeaves().size() == FL.LISTINGS
    assert rows(parts.filter("year = 3")) == rows(whole.filter("year = 3")) != []
    flat = str(tmp_path / "flat")
    df.write.parquet(flat)
    assert rows(FL.read_directories(spark, flat, SC.SONGS)) == rows(spark.read.schema(SC.SONGS).parquet(flat))
