"""The key index: which files hold which keys, without reading the files."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import rows
from strata.plans import etl_run as R
from strata.sinks import KeyIndex, write_parquet
from test_runs import chat, match, region, summary

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("day", StringType())])


def add(spark, path, day, keys):
    df = spark.createDataFrame([(k, f"{day}-{k}", day) for k in keys], SCHEMA)
    write_parquet(df, path, "append", ["day"])


def keys_of(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def test_hits_equal_the_table_and_only_new_files_are_indexed(spark, tmp_path):
    rng = random.Random(1)
    path, held = str(tmp_path / "t"), {}
    index = KeyIndex(spark, path, "k", SCHEMA)
    assert index.refresh() == 0 and index.hits(keys_of(spark, [1])).collect() == []
    pool = [0, 1, -1, 32767, 32768, 32769, 65536, -32768, 2 ** 40, -2 ** 50, 2 ** 63 - 1, -2 ** 63, None] + [rng.randint(-10 ** 6, 10 ** 6) for _ in range(300)]
    for day in ("a", "b c", "d%1"):
        held[day] = rng.sample(pool, 120)
        add(spark, path, day, held[day])
        assert index.refresh() > 0 and index.refresh() == 0
    every = {k for ks in held.values() for k in ks}
    assert {r["k"] for r in index.hits(keys_of(spark, pool)).collect()} == every
    assert {r["k"] for r in index.missing(keys_of(spark, pool)).collect()} == set(pool) - every
    only = [k for k in held["b c"] if k not in held["a"] and k not in held["d%1"]][:1]
    files = index.read(keys_of(spark, only))
    assert {r["day"] for r in files.collect()} == {"b c"}
    assert set(only) <= {r["k"] for r in files.collect()}
    assert sorted(spark.read.schema(SCHEMA).parquet(path).select("v").collect()) == sorted(  # readers do not see the index
        spark.createDataFrame([(f"{d}-{k}",) for d, ks in held.items() for k in ks], "v string").collect())


def test_an_overwrite_and_vanished_files_leave_no_stale_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    index = KeyIndex(spark, path, "k", SCHEMA)
    add(spark, path, "a", [1, 2])
    add(spark, path, "b", [3])
    index.refresh()
    new = spark.createDataFrame([(9, "x", "a")], SCHEMA)
    write_parquet(new, path, "overwrite", ["day"], replace="partitions")
    index.refresh()
    assert {r["k"] for r in index.hits(keys_of(spark, [1, 2, 3, 9])).collect()} == {3, 9}
    write_parquet(new, path, "overwrite", ["day"])
    index.refresh()
    assert {r["k"] for r in index.hits(keys_of(spark, [1, 2, 3, 9])).collect()} == {9}


def test_only_integral_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyIndex(spark, str(tmp_path), "v", SCHEMA)


@pytest.mark.parametrize("refresh", [False, True])
def test_a_tenth_run_opens_no_chat_file_of_older_runs(spark, tmp_path, monkeypatch, refresh):
    root, opened = str(tmp_path), []
    real = KeyIndex._read_files
    monkeypatch.setattr(KeyIndex, "_read_files", lambda self, files: opened.append((self.target, files)) or real(self, files))
    for k in range(4):
        opened.clear()
        R.run_chat_etl(spark, chat(spark, (k + 1, "gg ez" if k % 2 else "hello", 1, "a"), (k + 1, "gl", 2, "b")), match(spark, k + 1),
                       region(spark, 1), root, f"2024-02-{k + 1:02d} 00:00:00", refresh=refresh)
        files = [f for t, fs in opened if t.endswith("chat_data") for f in fs]
        assert files and all(f.startswith(f"run_date=2024-02-{k + 1:02d}") for f in files)
    want = {k + 1: (bool(k % 2), 1 if k % 2 else 2, "R1") for k in range(4)}
    assert summary(spark, root) == want
    # lines of a loaded match: dropped by match, compared row by row with refresh
    opened.clear()
    late = chat(spark, (2, "gl", 2, "b"), (2, "noob", 3, "c"))
    rep = R.run_chat_etl(spark, late, match(spark, 2), region(spark, 1), root, "2024-02-09 00:00:00", refresh=refresh)
    assert rep.loaded["chat_data"] == int(refresh)
    days = {f.split("/")[0] for t, fs in opened if t.endswith("chat_data") for f in fs}
    assert days <= {"run_date=2024-02-02", "run_date=2024-02-09"}
    assert summary(spark, root)[2] == ((True, 2, "R1") if refresh else (True, 1, "R1"))


def test_an_index_that_was_lost_is_built_again(spark, tmp_path):
    import shutil
    root = str(tmp_path)
    args = (match(spark, 1), region(spark, 1), root)
    R.run_chat_etl(spark, chat(spark, (1, "gg", 1, "a")), *args, "2024-02-01 00:00:00")
    for t in ("chat", "summary"):
        shutil.rmtree(tmp_path / R.chat_paths(root)[t].rsplit("/", 1)[-1] / "_key_index")
    rep = R.run_chat_etl(spark, chat(spark, (1, "gg", 1, "a")), *args, "2024-02-02 00:00:00")
    assert rep.loaded["chat_data"] == rep.loaded["match_summary_data"] == 0
    assert rows(spark.read.parquet(R.chat_paths(root)["chat"]), "match_id") == [(1,)]
