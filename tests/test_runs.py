"""Whole jobs over several runs: late rows, repeated runs, the gate."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata import schemas as SC
from strata.plans import etl_run as R

RUNS = ("2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00")
CHAT = "match_id long, key string, slot int, time long, unit string"


def chat(spark, *lines):
    return spark.createDataFrame([(m, t, 0, s, p) for m, t, s, p in lines], CHAT)


def match(spark, *ids, cluster=1):
    raw = spark.range(1).select(F.explode(F.lit(list(ids)).cast("array<long>")).alias("match_id"))
    m = F.col("match_id")
    return raw.select("match_id", (F.lit(1446750112) + m * 86400).alias("start_time"), *[F.lit(1).cast("long").alias(c) for c in (
        "duration", "tower_status_radiant", "tower_status_dire", "barracks_status_dire", "barracks_status_radiant", "first_blood_time",
        "game_mode")], F.lit(True).alias("radiant_win"), F.lit(0).alias("negative_votes"), F.lit(0).alias("positive_votes"),
        F.lit(cluster).alias("cluster"))


def region(spark, *clusters):
    return spark.createDataFrame([(c, f"R{c}") for c in clusters], "cluster int, region string")


def summary(spark, root):
    df = spark.read.schema(SC.MATCH_SUMMARY).parquet(R.chat_paths(root)["summary"])
    return {r["match_id"]: (r["toxic"], r["toxic_count"], r["region"]) for r in df.collect()}


@pytest.mark.parametrize("refresh", [False, True])
def test_a_match_later_than_its_chat_is_summarised(spark, tmp_path, refresh):
    root = str(tmp_path)
    lines = chat(spark, (1, "gg ez", 1, "a"), (2, "hello", 1, "b"))
    R.run_chat_etl(spark, lines, match(spark, 1), region(spark, 1), root, RUNS[0], refresh=refresh)
    assert summary(spark, root) == {1: (True, 1, "R1")}
    R.run_chat_etl(spark, lines.limit(0), match(spark, 1, 2), region(spark, 1), root, RUNS[1], refresh=refresh)
    assert summary(spark, root) == {1: (True, 1, "R1"), 2: (False, 1, "R1")}


@pytest.mark.parametrize("refresh", [False, True])
def test_a_region_later_than_its_matches_is_summarised(spark, tmp_path, refresh):
    root = str(tmp_path)
    lines = chat(spark, (1, "gg ez", 1, "a"), (5, "hello", 1, "b"))
    both = match(spark, 1).unionByName(match(spark, 5, cluster=9))
    R.run_chat_etl(spark, lines, both, region(spark, 1), root, RUNS[0], refresh=refresh)
    assert set(summary(spark, root)) == {1}
    R.run_chat_etl(spark, lines.limit(0), both, region(spark, 1, 9), root, RUNS[1], refresh=refresh)
    assert summary(spark, root) == {1: (True, 1, "R1"), 5: (False, 1, "R9")}


def test_late_lines_change_a_summary_only_with_refresh(spark, tmp_path):
    first, late = chat(spark, (1, "hello", 1, "a")), chat(spark, (1, "hello", 1, "a"), (1, "noob", 2, "b"))
    for refresh, want in ((False, (False, 1, "R1")), (True, (True, 1, "R1"))):
        root = str(tmp_path / str(refresh))
        for run, lines in zip(RUNS, (first, late, late)):
            R.run_chat_etl(spark, lines, match(spark, 1, 3), region(spark, 1), root, run, refresh=refresh)
        assert summary(spark, root) == {1: want}


@pytest.mark.parametrize("refresh", [False, True])
def test_a_run_writes_few_files_however_many_dates_it_has(spark, tmp_path, refresh):
    root, ids = str(tmp_path), range(1, 201)  # a match a day
    lines = chat(spark, *[(i, "gg ez", 1, "a") for i in ids])
    for run in RUNS[:2]:
        R.run_chat_etl(spark, lines, match(spark, *ids), region(spark, 1), root, run, refresh=refresh)
    assert summary(spark, root) == {i: (True, 1, "R1") for i in ids}
    for table in ("match", "summary"):
        assert len(spark.read.parquet(R.chat_paths(root)[table]).inputFiles()) < 20


def test_a_refresh_keeps_the_rows_of_other_dates(spark, tmp_path):
    root = str(tmp_path)
    R.run_chat_etl(spark, chat(spark, (1, "hello", 1, "a"), (2, "hello", 1, "a")), match(spark, 1, 2), region(spark, 1), root, RUNS[0],
                   refresh=True)
    renamed = spark.createDataFrame([(1, "new")], "cluster int, region string")
    rep = R.run_chat_etl(spark, chat(spark, (2, "noob", 2, "b")), match(spark, 1, 2), renamed, root, RUNS[1], refresh=True)
    assert rep.loaded["match_summary_data"] == 1
    assert summary(spark, root) == {1: (False, 1, "R1"), 2: (True, 1, "new")}


def test_the_gate_ends_a_run_before_its_summary(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(R.DataQualityError):
        R.run_chat_etl(spark, chat(spark, (1, "gg", 1, "a"), (77, "no match", 1, "a")), match(spark, 1), region(spark, 1), root,
                       RUNS[0], raise_on_fail=True)
    assert not R.path_exists(spark, R.chat_paths(root)["summary"])


def test_a_run_reads_the_text_of_its_own_run_date_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    R.run_chat_etl(spark, chat(spark, (1, "gg", 1, "a")), match(spark, 1, 2), region(spark, 1), root, RUNS[0])
    seen = []
    real = R.T.chat_by_match
    monkeypatch.setattr(R.T, "chat_by_match", lambda lines, *a, **k: seen.append(lines) or real(lines, *a, **k))
    R.run_chat_etl(spark, chat(spark, (2, "gg", 1, "a")), match(spark, 1, 2), region(spark, 1), root, RUNS[1])
    files = seen[0].inputFiles()
    assert files and all("run_date=2024-02-02" in f for f in files)
    shuffled = real(seen[0])._jdf.queryExecution().executedPlan().toString()
    assert all("chat#" not in line for line in shuffled.splitlines() if "Exchange" in line)


def test_star_job_keeps_users_and_repeats_cleanly(spark, tmp_path):
    ev = {"artist": "A", "firstName": "F", "lastName": "L", "gender": "F", "length": 1.5, "level": "free", "location": "x",
          "page": "NextSong", "song": "T", "userAgent": "ua", "itemInSession": 0, "status": 200}
    for month, user in (("01", 1), ("02", 2)):
        d = tmp_path / "log" / month
        d.mkdir(parents=True)
        (d / "a.json").write_text(json.dumps({**ev, "event_id": user, "userId": user, "sessionId": user, "ts": 1541106106000 + user}) + "\n")
    songs = spark.createDataFrame([(1, "AR1", "A", None, None, "x", "S1", "T", 1.5, 2000)],
                                  "num_songs int, artist_id string, artist_name string, artist_latitude double, artist_longitude double, "
                                  "artist_location string, song_id string, title string, duration double, year int")
    root = str(tmp_path / "out")
    for month in ("01", "02", "02"):
        R.run_star_etl(spark, "{base}/log/{month}", songs, root, base=str(tmp_path), month=month)
    p = R.star_paths(root)
    assert rows(spark.read.parquet(p["users"]), "user_id") == [(1,), (2,)]
    assert rows(spark.read.parquet(p["songplays"]), "user_id", "song_id") == [(1, "S1"), (2, "S1")]
    R.run_star_etl(spark, "{base}/log/{month}", songs, root, append_fact=True, base=str(tmp_path), month="02")
    assert spark.read.parquet(p["songplays"]).count() == 3


def test_star_job_reads_its_songs_once(spark, tmp_path, monkeypatch):
    d = tmp_path / "log" / "01"
    d.mkdir(parents=True)
    (d / "a.json").write_text(json.dumps({"event_id": 1, "userId": 1, "sessionId": 1, "page": "NextSong", "song": "T", "artist": "A", "length": 1.5,
                                          "level": "free", "ts": 1541106106000}) + "\n")
    read = spark.sparkContext.accumulator(0)
    columns = ("num_songs int, artist_id string, artist_name string, artist_latitude double, artist_longitude double, "
               "artist_location string, song_id string, title string, duration double, year int")

    def song(_):
        read.add(1)
        return (1, "AR1", "A", None, None, "x", "S1", "T", 1.5, 2000)

    songs = spark.createDataFrame(spark.sparkContext.parallelize([0], 1).map(song), columns)
    R.run_star_etl(spark, "{base}/log/{month}", songs, str(tmp_path / "out"), base=str(tmp_path), month="01")
    assert read.value == 1
