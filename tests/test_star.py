import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import lookups as L
from strata.plans import star as ST
from conftest import rows

EV_SCHEMA = ("event_id long, artist string, firstName string, gender string, itemInSession int, "
             "lastName string, length double, level string, location string, page string, sessionId long, "
             "song string, ts long, userAgent string, userId long")
T0 = 1541106106000  # 2018-11-01 21:01:46 UTC


def _events(spark):
    return spark.createDataFrame([
        (1, "A1", "Ann", "F", 0, "Lee", 100.5, "free", "NY", "NextSong", 11, "Song1", T0, "ua", 7),
        (2, "A1", "Anne", "F", 1, "Lee", 100.5, "paid", "NY", "NextSong", 11, "Song1", T0 + 300, "ua", 7),
        (3, "A2", "Bo", "M", 0, "Ng", 200.0, "free", "LA", "NextSong", 12, "Song2", T0 + 300, "ua", 8),
        (4, "", "Bo", "M", 1, "Ng", None, "free", "LA", "Home", 12, None, T0 + 900, "ua", 8),
        (5, "A9", "Cy", "M", 0, "Oh", 1.0, "free", "SF", "NextSong", None, "Nope", T0 + 999, "ua", None),
        (6, "A2", "Bo", "M", 1, "Ng", 200.0, "paid", "LA", "NextSong", 12, "Song2", T0 + 5000, "ua", 8),
    ], EV_SCHEMA)


def _songs(spark):
    return spark.createDataFrame([
        (1, 1, "AR1", "A1", None, None, "NY", "S1", "Song1", 100.5, 2000),
        (2, 1, "AR2", "A2", 1.5, 2.5, "LA", "S2", "Song2", 200.0, 2001),
        (3, 1, "AR3", "A3", 1.5, 2.5, "LA", "S3", "Song2", 200.0, 2001),   # same title+duration, other artist
        (4, 1, "AR2", "A2 again", 1.5, 2.5, "LA", "S4", "Song4", 3.0, 2001),
    ], "song_key long, num_songs int, artist_id string, artist_name string, artist_latitude double, "
       "artist_longitude double, artist_location string, song_id string, title string, duration double, year int")


def test_users_policies(spark):
    ev = _events(spark)
    assert ST.users_dim(ev, "none").count() == 5
    assert rows(ST.users_dim(ev, "distinct")) == [
        (7, "Ann", "Lee", "F", "free"), (7, "Anne", "Lee", "F", "paid"),
        (8, "Bo", "Ng", "M", "free"), (8, "Bo", "Ng", "M", "paid")]
    assert rows(ST.users_dim(ev, "first_last_level")) == [(7, "Ann", "Lee", "F", "paid"),
                                                           (8, "Bo", "Ng", "M", "paid")]


def test_artist_policies(spark):
    s = _songs(spark)
    assert rows(ST.artists_dim(s, "first"), "artist_id", "name") == [("AR1", "A1"), ("AR2", "A2"), ("AR3", "A3")]
    assert ST.artists_dim(s, "distinct").count() == 4
    assert ST.artists_dim(s, "none").count() == 4


def test_songplays_variants(spark):
    ev, s = _events(spark), _songs(spark)
    wh = ST.songplays_warehouse(ev, s)
    # sessionId null play is dropped; 3-key join matches exactly one song
    assert wh.count() == 4
    assert rows(wh, "song_id") == [("S1",), ("S1",), ("S2",), ("S2",)]
    # two-key join fans out on a shared title+duration
    lake = ST.songplays_lake(ev, s)
    assert lake.count() == 7
    # lookup never fans out; dedup on (session, time, user)
    lk = ST.songplays_lookup(ev, ST.songs_dim(s, "first"), ST.artists_dim(s, "first"))
    assert lk.count() == 5
    # keyed on start_time alone, the concurrent play of another user is dropped
    one = ST.songplays_lookup(ev, ST.songs_dim(s, "first"), ST.artists_dim(s, "first"), dedup_key=("start_time",))
    assert one.count() == 4


def test_warehouse_time_is_whole_seconds(spark):
    wh = ST.songplays_warehouse(_events(spark), _songs(spark))
    t = ST.time_dim(wh, convention="warehouse")
    got = rows(t)
    assert got[0][0] == dt.datetime(2018, 11, 1, 21, 1, 46)
    assert got[0][1:] == (21, 1, 44, 11, 2018, 4)  # Thursday = 4 with Sunday = 0


def test_lookup_tables_last_write_wins(spark):
    ev = _events(spark)
    dup = ev.union(spark.createDataFrame(
        [(9, "A7", "Bo", "M", 1, "Ng", 7.0, "free", "LA", "NextSong", 12, "Late", T0 + 9000, "ua", 8)], EV_SCHEMA))
    si = L.session_items(dup)
    assert rows(L.session_item_lookup(si, 12, 1)) == [("A7", "Late", 7.0)]
    us = L.user_sessions(dup)
    assert [tuple(r) for r in L.user_session_lookup(us, 8, 12).collect()] == [
        (0, "A2", "Song2", "Bo Ng"), (1, "A7", "Late", "Bo Ng")]
    assert rows(L.song_listener_lookup(L.song_listeners(dup), "Song1")) == [("Ann Lee",), ("Anne Lee",)]
    # the empty-artist row never reaches the tables
    assert L.event_rows(ev).filter("artist = ''").count() == 0


def test_users_of_all_pages_skip_falsy_ids(spark):
    ev = _events(spark).unionByName(spark.createDataFrame([
        (7, None, "Di", "F", 0, "Po", None, "free", "NY", "Login", 13, None, T0 + 1, "ua", 9),
        (8, None, "No", "F", 0, "One", None, "free", "NY", "Login", 14, None, T0 + 2, "ua", 0)], EV_SCHEMA))
    got = rows(ST.users_dim(ev, "first_last_level", pages="all"))
    assert got == [(7, "Ann", "Lee", "F", "paid"), (8, "Bo", "Ng", "M", "paid"), (9, "Di", "Po", "F", "free")]
    text = ev.withColumn("userId", F.coalesce(F.col("userId").cast("string"), F.lit("")))
    assert [r[0] for r in rows(ST.users_dim(text, "first_last_level", pages="all"))] == ["0", "7", "8", "9"]
    assert ST.users_dim(ev, "none", pages="all").count() == 6
    assert ST.users_dim(ev.limit(0), "distinct", pages="all").count() == 0
    with pytest.raises(ValueError):
        ST.users_dim(ev, pages="some")
