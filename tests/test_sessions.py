import pytest
from pyspark.sql import functions as F

from checks.fixtures import track
from footfall.operators import sessions
from footfall.operators.timeline import Timeline
from tests.helpers import DAY, HOUR, column, events

NOON = DAY + 12 * HOUR


def flags(df, name="newSession"):
    return column(df, name)


@pytest.mark.parametrize("gap, new", [(1_799_999, False), (1_800_000, True)])
def test_a_gap_of_exactly_the_timeout_ends_the_session(spark, gap, new):
    rows = events(spark, (NOON, "a"), (NOON + gap, "b"))
    assert flags(sessions.sessionize_v2(rows)) == [True, new]


def test_midnight_ends_the_session_in_the_zone_asked_for(spark):
    rows = events(spark, (DAY - 1000, "a"), (DAY + 1000, "b"))
    assert flags(sessions.sessionize_v2(rows)) == [True, True]
    assert flags(sessions.sessionize_v2(rows, tz="Asia/Shanghai")) == [True, False]
    shanghai = DAY - 8 * HOUR
    rows = events(spark, (shanghai - 1000, "a"), (shanghai + 1000, "b"))
    assert flags(sessions.sessionize_v2(rows, tz="Asia/Shanghai")) == [True, True]


def test_restarting_events_open_the_session_they_belong_to(spark):
    rows = events(
        spark,
        (NOON, "pageview"),
        (NOON + 1, "openChannel"),
        (NOON + 2, "jPush", {"eventBody": '{"dcid":0,"dtg":5}'}),
        (NOON + 3, "jPush", {"eventBody": '{"dcid":2}'}),
        (NOON + 4, "jPush", {"eventBody": '{"dcid":2,"dtg":5}'}),
        (NOON + 5, "click", {"eventBody": '{"dcid":2,"dtg":5}'}),
    )
    out = sessions.sessionize_v2(rows)
    assert flags(out) == [True, True, False, False, True, False]
    assert column(out, "seStartTime") == [NOON] + [NOON + 1] * 3 + [NOON + 4] * 2
    assert flags(sessions.sessionize_v2(rows, triggers=False)) == [True] + [False] * 5


def test_devices_and_sites_do_not_mix(spark):
    rows = events(
        spark, (NOON, "a"), (NOON + 1, "a", {"deviceId": "d2"}), (NOON + 2, "a", {"siteId": "s2"}),
        (NOON + 3, "a"),
    )
    assert flags(sessions.sessionize_v2(rows)) == [True, True, True, False]


def test_session_id_has_16_hex_characters_and_follows_the_prefix(spark):
    rows = events(spark, (NOON, "a"))
    plain, other = (column(sessions.sessionize_v2(rows, prefix=p), "sessionId")[0] for p in ("", "x"))
    assert len(plain) == 16 and int(plain, 16) >= 0 and plain != other


def test_known_session_counts(spark):
    rows = track(spark, "/root/testdata/sf0.01")
    assert sessions.sessions_per_device(rows, triggers=False).count() == 9550
    assert sessions.sessionize_v1(rows).where("new_visit").count() == 9549


def test_session_sizes_add_up(spark, sf):
    rows = track(spark, sf)
    assert sessions.sessions_per_device(rows).agg(F.sum("n_events")).first()[0] == rows.count()


def test_legacy_visits(spark):
    rows = events(
        spark,
        (NOON, "pageview", {"url": "http://app/a"}),
        (NOON + 5000, "pageview", {"url": "http://app/b?utm_campaign=c"}),
        (NOON + 6000, "click"),
        (NOON + 6000 + 1_800_000, "click", {"url": "http://app/x?utm_campaign=c"}),
    )
    out = sessions.visit_counters(sessions.sessionize_v1(Timeline(rows))).frame().orderBy("sn")
    got = [tuple(r) for r in out.select("new_visit", "_idvc", "_viewts", "_idts").collect()]
    s = NOON // 1000
    assert got == [
        (True, 1, s, s), (True, 2, s, s), (False, 2, s, s), (True, 3, s + 5, s),
    ]
    (visitor,) = sessions.visitor_table(out).collect()
    assert (visitor.first_visit, visitor.previous_visit, visitor.visits) == (s, s + 5, 3)
