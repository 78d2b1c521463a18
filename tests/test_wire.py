from hypothesis import HealthCheck, given, settings, strategies as st
from urllib.parse import quote

from pyspark.sql import functions as F

from footfall.functions import escape_value, unescape_value
from footfall.plans.rebuild import ingest
from footfall.sources import wire
from tests.conftest import rows_of
from tests.helpers import DAY, column, events


def decode(spark, *bodies, by=wire.decode_bulk_v2):
    return by(spark.createDataFrame([(b,) for b in bodies], "body STRING"))


def one(spark, item, by=wire.decode_bulk_v2):
    body = '{"requests":["%s"]}' % item.replace("\\", "\\\\").replace('"', '\\"')
    (row,) = decode(spark, quote(body) if by is wire.decode_bulk_v2 else body, by=by).collect()
    return row


def test_values_keep_plus_equals_and_unescaped_ampersands(spark):
    row = one(spark, '?siteId=s1&userProperty={"a":"x&y=1"}&url=http://a/b%3Fc=d%26e=f+g&eventTime=12&sn=18446744073709551615')
    assert row.siteId == "s1" and row.userProperty == '{"a":"x&y=1"}'
    assert row.url == "http://a/b?c=d&e=f+g"
    assert row.eventTime == 12 and int(row.sn) == 2**64 - 1
    assert not row.malformed and row.extra == {}


def test_only_escaped_parameters_are_unescaped(spark):
    row = one(spark, "?customerVar=%3F&title=%3F")
    assert (row.customerVar, row.title) == ("%3F", "?")


def test_reserved_and_leading_unknown_names_land_in_extra(spark):
    row = one(spark, "?mine=1&siteId=s1&ip=1.2.3.4&channelId=c&channelId=d")
    assert row.siteId == "s1" and row.extra == {"mine": "1", "ip": "1.2.3.4", "channelId": "d"}


def test_the_last_of_repeated_names_wins(spark):
    assert one(spark, "?siteId=a&userId=u&siteId=b").siteId == "b"


def test_unreadable_values_become_null(spark):
    row = one(spark, "?eventTime=soon&sn=&lat=1.5&lgt=x")
    assert (row.eventTime, row.sn, row.lat, row.lgt) == (None, None, 1.5, None)


def test_unreadable_bodies_give_one_malformed_row_each(spark):
    out = decode(spark, "%7Bnope", "%zz", None, quote('{"requests":[]}'), quote('{"other":1}'))
    assert [r.malformed for r in out.collect()] == [True] * 5


def test_legacy_bodies_are_not_percent_decoded(spark):
    row = one(spark, "?idsite=s1&url=a%20b&cvar={\"5\":[\"x\",\"{Lifetime_seq:12}\"]}&lang=en", by=wire.decode_bulk_v1)
    assert (row.url, row.extra) == ("a%20b", {"lang": "en"})
    assert row.cvar == '{"5":["x","{Lifetime_seq:12}"]}'


def test_body_keeps_url_characters_and_escapes_the_rest(spark):
    out = wire.encode_bulk(events(spark, (DAY, "a", {"url": "http://x/ü (1)"}))).first().body
    assert out.startswith("%7B%22requests%22:%5B%22?projectId=p1&siteId=s1")
    assert "url=http://x/%C3%BC%20(1)" in out


# `%3F` and `%26` inside a value cannot be told from escapes
TEXT = st.text(st.characters(blacklist_categories=("Cs", "Cc")), max_size=20).filter(
    lambda s: "%3F" not in s and "%26" not in s)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, TEXT, TEXT), min_size=40, max_size=60))
def test_round_trip(spark, texts):
    rows = events(spark, *[
        (DAY + i, "custom", {"url": u, "title": t, "deviceId": f"d{i % 3}", "eventBody": '{"k":"v&w?"}',
                             "userProperty": '{"a":"&b=c"}', "referrer": r})
        for i, (u, t, r) in enumerate(texts)])
    names = ["deviceId", "sn", "eventTime", "eventName", "url", "title", "referrer", "eventBody", "userProperty"]
    back = wire.decode_bulk_v2(wire.encode_bulk(rows, 7).select("body"))
    assert rows_of(back, *names) == rows_of(rows, *names)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=30, max_size=40))
def test_escape_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", escape_value("t").alias("e"))
    for r in df.select("t", "e", unescape_value("e").alias("back")).collect():
        assert r.back == r.t and "?" not in r.e and "&" not in r.e


def test_requests_hold_ten_events_oldest_first(spark):
    rows = events(spark, *[(DAY + 100 - i, "a") for i in range(25)])
    out = wire.encode_bulk(rows).orderBy("batch").collect()
    assert [(r.batch, r.n_events) for r in out] == [(0, 10), (1, 10), (2, 5)]
    back = decode(spark, *[r.body for r in out]).select("eventTime", "position")
    assert column(back.where("position = 0"), "eventTime", "eventTime") == [DAY + 76, DAY + 86, DAY + 96]


def test_ingest_drops_resent_copies_and_quarantines(spark):
    body = wire.encode_bulk(events(spark, (DAY, "a"), (DAY + 1, "b"))).first().body
    payloads = spark.createDataFrame([(body,), (body,), ("%7Bno",), (quote('{"requests":["?siteId=s"]}'),)], "body STRING")
    good, bad = ingest(payloads)
    assert sorted(r.eventName for r in good.collect()) == ["a", "b"]
    assert bad.count() == 2


def test_escape_touches_text_columns_only(spark):
    df = spark.createDataFrame([("a?b&c%", 1)], "t STRING, n INT")
    assert wire.escape_params(df).first() == ("a%3Fb%26c%", 1)
    assert wire.unescape_params(wire.escape_params(df)).first().t == "a?b&c%"


def test_reserved_names_come_back(spark):
    rows = events(spark, (DAY, "a"), (DAY + 1, "b")).withColumn(
        "extra", F.when(F.col("sn") == 1, F.create_map(F.lit("ip"), F.lit("1.2.3.4"), F.lit("city"), F.lit("x y"))))
    back = wire.decode_bulk_v2(wire.encode_bulk(rows).select("body"))
    assert {r.eventName: dict(r.extra or {}) for r in back.collect()} == {"a": {"ip": "1.2.3.4", "city": "x y"}, "b": {}}


def test_ties_stay_in_their_requests(spark):
    rows = events(spark, *[(DAY, f"e{i}", {"sn": 1}) for i in range(40)])
    bodies = [
        rows_of(wire.encode_bulk(rows.repartition(n, "eventName").sortWithinPartitions(F.desc("eventName")), 7), "batch", "body")
        for n in (1, 3, 8)
    ]
    assert bodies[0] == bodies[1] == bodies[2]


def test_custom_events_there_and_back(spark):
    from footfall.operators.bodies import encode_custom, parse_custom

    given = spark.createDataFrame(
        [("my_event", {"a": "1", "b": "x&y"}), ("no name", {"a": "1"}), ("login", {}), ("bare", None)],
        "eventName STRING, vars MAP<STRING,STRING>")
    back = parse_custom(encode_custom(given), keep=())
    assert {r.eventName: r.vars for r in back.collect()} == {"my_event": {"a": "1", "b": "x&y"}, "bare": {}}


def test_legacy_quarantine(spark):
    from footfall.plans.rebuild import ingest_legacy

    one = '?idsite=s1&deviceId=d&cdt=2024-01-01 00:00:05&e_a=a&r=7'
    other = one.replace("r=7", "r=8")
    bodies = [f'{{"requests":["{one}","{other}"]}}', f'{{"requests":["{one}"]}}', "broken", '{"requests":["?idsite=s1&e_a=b"]}']
    rows, bad = ingest_legacy(spark.createDataFrame([(b, b) for b in bodies], "body STRING, raw STRING"))
    assert rows_of(rows, "e_a", "r") == [("a", "7"), ("a", "8")]
    assert rows_of(bad, "raw", "malformed") == sorted([("broken", True), (bodies[3], False)])
