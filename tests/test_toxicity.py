import datetime as dt

from pyspark.sql import functions as F

from strata.plans import toxicity as T
from conftest import rows

RUN = "2024-02-01 00:00:00"


def _frames(spark):
    chat_raw = spark.createDataFrame([
        (1, "gg ez", 0, 10, "p1"), (1, "noob team", 1, 20, "p2"), (1, "hello", 2, 30, "p3"),
        (1, "gg ez", 0, 10, "p1"),            # exact duplicate, dropped on load
        (1, "EZ", 3, 40, None),               # upper case: harmless; null player
        (2, "good game", 0, 5, "p4"), (2, "wp", 1, 6, "p5"), (2, None, 2, 7, "p5"),  # null chat is harmless
        (3, "idiot", 0, 1, "p6"),             # match 3 has an unknown cluster
        (8, "moron", 0, 1, "p7"),             # chat for an unknown match
    ], "match_id long, key string, slot int, time long, unit string")
    match_raw = spark.createDataFrame([
        (1, 1446750112, 2000, 1, 1, 1, 1, 1, 22, True, 0, 1, 1),
        (2, 1446753712, 2000, 1, 1, 1, 1, 1, 22, False, 0, 1, 2),
        (3, 1446757312, 2000, 1, 1, 1, 1, 1, 22, False, 0, 1, 99),
        (4, 1446760912, 2000, 1, 1, 1, 1, 1, 22, False, 0, 1, 1),   # no chat
    ], "match_id long, start_time long, duration long, tower_status_radiant long, tower_status_dire long, "
       "barracks_status_dire long, barracks_status_radiant long, first_blood_time long, game_mode int, "
       "radiant_win boolean, negative_votes int, positive_votes long, cluster long")
    region_raw = spark.createDataFrame([(1, "EUROPE"), (2, "ASIA")], "cluster int, region string")
    return (T.chat_typed(chat_raw, RUN), T.match_typed(match_raw, RUN), T.region_typed(region_raw, RUN))


def test_match_summary_semantics(spark):
    chat, matches, regions = _frames(spark)
    got = rows(T.match_summary(chat, matches, regions))
    d = dt.date(2015, 11, 5)
    assert got == [
        # toxic match: 2 toxic messages by 2 players
        (1, d, True, 2, 2, "EUROPE"),
        # harmless match: counts are of its harmless messages (3 messages, 2 named players)
        (2, d, False, 3, 2, "ASIA"),
    ]


def test_direct_form_equals_preaggregated(spark):
    chat, matches, regions = _frames(spark)
    assert rows(T.match_summary_direct(chat, matches, regions)) == rows(T.match_summary(chat, matches, regions))


def test_strict_adds_true_toxic_count(spark):
    chat, matches, regions = _frames(spark)
    got = dict(T.match_summary(chat, matches, regions, strict=True).select("match_id", "toxic_messages").collect())
    assert got == {1: 2, 2: 0}


def test_kpis_and_region(spark):
    chat, matches, regions = _frames(spark)
    s = T.summary_with_chat(T.match_summary(chat, matches, regions), chat)
    k = T.toxic_kpis(s).first().asDict()
    assert k == {"total_matches": 2, "toxic_matches": 1, "total_players": 20, "toxic_players": 2,
                 "pct_toxic_matches": 50.0, "pct_toxic_players": 10.0}
    assert rows(T.most_toxic_region(s)) == [("EUROPE", 1, 50.0)]


def test_kpis_on_empty_and_harmless(spark):
    chat, matches, regions = _frames(spark)
    s = T.match_summary(chat, matches, regions)
    empty = s.filter(F.lit(False))
    k = T.toxic_kpis(empty).first()
    assert k["total_matches"] == 0 and k["pct_toxic_matches"] is None
    assert T.most_toxic_region(s.filter(~F.col("toxic"))).count() == 0
