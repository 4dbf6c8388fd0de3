import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from strata.functions import (TOXIC_WORDS, epoch_ms_to_ts, epoch_ms_to_ts_seconds, flag_word_hits,
                              full_name, is_flagged, md5_key, percent2, weekday)
from conftest import SF001


def test_word_hits_substring_case_sensitive(spark):
    df = spark.createDataFrame([(1, "you are a noob"), (2, "arsehole"), (3, "EZ game"), (4, None),
                                (5, "class act"), (6, "ez noob ez")], "id int, t string")
    got = dict(df.select("id", flag_word_hits("t").alias("h")).collect())
    # 'arsehole' hits 'arse'; 'class' hits 'ass' (substring); upper case does not hit;
    # a null message is the harmless 'g'; a word counts once however often it occurs.
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 2}


def test_word_hits_options(spark):
    df = spark.createDataFrame([(1, "EZ game"), (2, "class act"), (3, "ass.")], "id int, t string")
    ic = dict(df.select("id", flag_word_hits("t", ignore_case=True).alias("h")).collect())
    assert ic[1] == 1
    word = dict(df.select("id", flag_word_hits("t", mode="word").alias("h")).collect())
    assert word == {1: 0, 2: 0, 3: 1}


def test_flag_equals_count_positive(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bad = docs.filter(is_flagged("text") != (flag_word_hits("text") > 0)).count()
    assert bad == 0


def test_word_hits_match_python_twin(spark):
    """The column expression equals a vectorised pandas twin of the reference's per-row rule."""
    import pandas as pd

    @F.pandas_udf("int")
    def twin(s: pd.Series) -> pd.Series:
        return s.fillna("g").map(lambda t: sum(1 for w in TOXIC_WORDS if w in t)).astype("int32")

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    diff = docs.filter(flag_word_hits("text") != twin("text")).count()
    assert diff == 0


@pytest.mark.parametrize("num,den,want", [(1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (1, 800, 0.13),
                                          (0, 5, 0.0), (5, 5, 100.0), (1, 0, None)])
def test_percent2(spark, num, den, want):
    got = spark.range(1).select(percent2(F.lit(num), F.lit(den)).alias("p")).first()["p"]
    assert got == want


def test_weekday_conventions(spark):
    # 2024-01-07 is a Sunday, 2024-01-08 a Monday.
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12), ), (dt.datetime(2024, 1, 8, 12), )], "t timestamp")
    got = df.select(weekday("t", "spark"), weekday("t", "pandas"), weekday("t", "warehouse")).collect()
    assert [tuple(r) for r in got] == [(1, 6, 0), (2, 0, 1)]
    with pytest.raises(ValueError):
        weekday("t", "iso")


def test_epoch_conversions(spark):
    ms = 1541106106796  # 2018-11-01 21:01:46.796 UTC
    r = spark.range(1).select(epoch_ms_to_ts(F.lit(ms)).alias("a"),
                              epoch_ms_to_ts_seconds(F.lit(ms)).alias("b"),
                              F.hour(epoch_ms_to_ts(F.lit(ms))).alias("h")).first()
    assert r["a"] == dt.datetime(2018, 11, 1, 21, 1, 46, 796000)
    assert r["b"] == dt.datetime(2018, 11, 1, 21, 1, 46)
    assert r["h"] == 21  # 24-hour clock


def test_md5_key_and_name(spark):
    r = spark.range(1).select(
        md5_key(F.lit(123), F.lit(dt.datetime(2018, 11, 1, 21, 1, 46))).alias("k"),
        full_name(F.lit("Ann"), F.lit("Lee")).alias("n"),
        full_name(F.lit("Ann"), F.lit(None).cast("string")).alias("m")).first()
    assert r["k"] == hashlib.md5(b"1232018-11-01 21:01:46").hexdigest()
    assert r["n"] == "Ann Lee" and r["m"] is None
