"""File and line numbers of text files, dense ids, malformed and mapped JSON."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from conftest import rows
from strata.operators import numbering as N
from strata.operators.dedup import first_by_key, last_by_key
from strata.sources import files as FL
from strata.sources import ordered as OR


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_are_numbered_across_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want = []
    for name, n in (("a.txt", 400), ("b/c.txt", 1), ("b/d.txt", 333), ("e.txt", 0)):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        lines = ["x" * rng.randint(0, 40) + str(i) for i in range(n)]
        p.write_text("".join(x + "\n" for x in lines))
        want += [(name, i, x) for i, x in enumerate(lines, 1)]
    df = OR.ordered_lines(spark, str(tmp_path), recursive=True, glob="*.txt")
    got = [(r["file"].split(f"{tmp_path.name}/")[-1], r["line"], r["value"]) for r in df.collect()]
    assert sorted(got) == sorted(want)
    assert spark.read.option("recursiveFileLookup", "true").text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_first_and_last_line_win_over_files_and_splits(spark, tmp_path, small_splits):
    rng = random.Random(2)
    seen = []
    for f in ("x1.csv", "x2.csv", "x3.csv"):
        body = [(rng.randint(1, 30), f"{f}-{i}") for i in range(200)]
        seen += body
        (tmp_path / f).write_text('"v","k"\n' + "".join(f'"{v}","{k}"\n' for k, v in body))
    schema = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    df = OR.ordered_csv(spark, str(tmp_path), schema, glob="*.csv")
    assert df.count() == 600 and df.agg(F.min("line")).first()[0] == 2
    assert rows(first_by_key(df, ["k"], OR.ORDER), "k", "v") == sorted({k: v for k, v in reversed(seen)}.items(), key=repr)
    assert rows(last_by_key(df, ["k"], OR.ORDER), "k", "v") == sorted(dict(seen).items(), key=repr)


def test_csv_headers_are_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    schema = StructType([StructField("k", IntegerType())])
    assert OR.ordered_csv(spark, str(tmp_path), schema).select("k", "line").collect() == [(1, 2)]
    with pytest.raises(ValueError):
        OR.ordered_csv(spark, str(tmp_path), StructType([StructField("w", IntegerType())]))
    (tmp_path / "b.csv").write_text("v,k\ny,2\n")
    with pytest.raises(Exception, match="another CSV header"):
        OR.ordered_csv(spark, str(tmp_path), schema).collect()


def test_ids_are_dense_ordered_and_continue(spark, tmp_path):
    rng = random.Random(3)
    schema = StructType([StructField("id", LongType()), StructField("a", IntegerType()), StructField("b", StringType())])
    path, want = str(tmp_path / "t"), []
    for load in range(3):
        part = [(load * 100 + rng.randint(0, 99) if rng.random() < .9 else None, rng.choice("xyz")) for _ in range(300)]
        want += sorted(part, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        df = spark.createDataFrame(part, "a int, b string").repartition(7)
        assert N.append_numbered(spark, df, path, ["a", "b"], "id", schema) == 300
    got = [(r["a"], r["b"]) for r in spark.read.schema(schema).parquet(path).orderBy("id").collect()]
    assert got == want
    assert rows(spark.read.schema(schema).parquet(path), "id") == sorted(((i,) for i in range(1, 901)), key=repr)
    assert N.append_numbered(spark, spark.createDataFrame([], "a int, b string"), path, ["a", "b"], "id", schema) == 0


ROW = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
LINES = ['{"a": 1, "b": "x"}', '{"a": 2, "b": "cu', "not json", '{"b": "no a"}', '{"a": "text", "b": "y"}', "", '{"a": null, "b": "z"}']


def test_malformed_json_lines_raise_or_are_kept(spark, tmp_path):
    (tmp_path / "f.json").write_text("\n".join(LINES) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        FL.read_json(spark, str(tmp_path / "f.json"), ROW).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        FL.stage_json(spark, str(tmp_path), ROW, str(tmp_path) + "-out")
    kept = FL.read_json(spark, str(tmp_path / "f.json"), ROW, on_bad="keep")
    assert {r["corrupt_record"] for r in kept.collect()} == {LINES[1], LINES[2], LINES[4], None}
    with pytest.raises(ValueError):
        FL.read_json(spark, str(tmp_path), ROW, on_bad="ignore")


def test_quarantine_holds_file_line_and_text(spark, tmp_path):
    src, out, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad")
    src.mkdir()
    (src / "f.json").write_text("\n".join(LINES) + "\n")
    rep = FL.stage_json_report(spark, "{d}", ROW, out, quarantine=bad, d=str(src))
    assert rep == {"loaded": 3, "rejected": 3}
    assert rows(spark.read.parquet(out), "a", "b") == sorted([(1, "x"), (None, "no a"), (None, "z")], key=repr)
    got = spark.read.parquet(bad).collect()
    assert sorted((r["line"], r["corrupt_record"]) for r in got) == [(2, LINES[1]), (3, LINES[2]), (5, LINES[4])]
    assert all(r["file"].endswith("/f.json") for r in got)
    (src / "f.json").write_text(LINES[0] + "\n")
    assert FL.stage_json_report(spark, "{d}", ROW, out, quarantine=bad, d=str(src)) == {"loaded": 1, "rejected": 0}
    assert spark.read.parquet(bad).count() == 0


def test_mapped_paths(spark, tmp_path):
    src, out, bad, paths = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad"), tmp_path / "paths.json"
    src.mkdir()
    docs = [{"u": {"the a": 5}, "l": [{"b": "x"}]}, {"u": {}, "l": []}, {"u": {"the a": "text"}, "l": [{"b": "y"}]}, {"u": {"the a": None}, "l": [{"b": "q"}]}]
    (src / "f.json").write_text("\n".join(map(json.dumps, docs)) + "\ncut {\n")
    paths.write_text(json.dumps({"jsonpaths": ["$['u']['the a']", "$.l[0].b"]}))
    rep = FL.stage_json_report(spark, str(src), ROW, out, mapping=str(paths), quarantine=bad)
    assert rep == {"loaded": 3, "rejected": 2}
    assert rows(spark.read.parquet(out), "a", "b") == sorted([(5, "x"), (None, None), (None, "q")], key=repr)
    assert rows(spark.read.parquet(bad), "line", "corrupt_record") == sorted([(3, json.dumps(docs[2])), (5, "cut {")], key=repr)
    with pytest.raises(Exception, match="malformed line"):
        FL.stage_json(spark, str(src), ROW, out, mapping=str(paths))
    with pytest.raises(ValueError):
        FL.mapped_json(spark.range(1).select(F.lit("{}").alias("value")), ROW, ["$.a"])
