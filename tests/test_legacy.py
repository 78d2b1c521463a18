import json

from pyspark.sql import functions as F

from footfall.operators import bridge, filters, legacy, projections
from footfall.operators.dims import DEVICE_MODELS, RADIO_LABELS, pairs, with_device_model, with_network_type
from footfall.schema import SCREEN_DENYLIST
from tests.conftest import rows_of
from tests.helpers import DAY, column, events


def mapped(spark, *rows):
    return legacy.to_legacy(events(spark, *rows)).orderBy("sn")


def test_mapping_rules(spark):
    out = mapped(
        spark,
        (DAY, "login", {"userId": 'u"1', "eventBody": '{"registrationID":"r"}'}),
        (DAY, "login"),
        (DAY, "search", {"eventBody": '{"keyword":"kw"}'}),
        (DAY, "pageview", {"url": "u?utm_campaign=c", "title": "t", "eventBody": '{"udVariable":{"b":"2","a":"1"}}'}),
        (DAY, "addCart", {"url": "u", "title": "t", "eventBody": '{"sku":"s"}'}),
        (DAY, "jPush"), (DAY, "initJPush"), (DAY, "openChannel"),
    ).collect()
    assert [r.e_a for r in out] == ["login", "login", None, "pageview", "addCart"]
    assert [r.e_c for r in out] == ["event1.0", "event1.0", None, None, "event1.0"]
    assert [r.e_n for r in out] == ['{"registrationID":"r","uid":"u\\"1"}', "{}", None, None, '{"sku":"s"}']
    assert [r.search for r in out] == [None, None, "kw", None, None]
    page = out[3]
    assert (page.url, page.title, page.action_name, page.new_visit) == ("u?utm_campaign=c", "t", "t", "1")
    assert page.customvariable == "[{keyName:a, keyValue:1},{keyName:b, keyValue:2}]"
    assert [r.url for r in out[4:]] == [None] and {r.ec_tx for r in out} == {"0"}


def test_item_rows_of_orders(spark):
    rows = events(spark, (DAY, "order", {"eventBody": None})).withColumns(
        {"ec_items": F.lit("[[]]"), "ec_id": F.lit("o1"), "revenue": F.lit("1.00"), "ec_sh": F.lit("0.10"), "ec_st": F.lit("0.90")})
    row = legacy.request_vars(legacy.to_legacy(rows)).first()
    assert (row.idgoal, row.e_n, row.revenue, row.ec_id, row.ec_st) == ("0", "", "1.00", "o1", "0.90")
    assert row.cvar is None  # orders carry no serial number


def test_request_vars_and_serial(spark):
    out = legacy.request_vars(mapped(spark, (DAY, "addCart", {"sn": 7}), (DAY, "search", {"eventBody": '{"keyword":"k"}', "sn": 8})))
    out = legacy.parse_lifetime_seq(out)
    assert column(out, "cvar") == ['{"5":["systemvariable","{Lifetime_seq:7}"]}', None]
    assert [None if v is None else int(v) for v in column(out, "lifetime_seq")] == [7, None]


def test_custom_dimension(spark):
    texts = ["[{keyName:a, keyValue:b}]", "[{keyName:a, keyValue:x, y},{keyName:b, keyValue:},{keyName:a, keyValue:2}]", "none", None]
    df = spark.createDataFrame([(t,) for t in texts], "customvariable STRING")
    got = [r.dimension for r in legacy.decode_custom_dimension(df).collect()]
    assert got == [{"a": "b"}, {"a": "x, y", "b": ""}, {}, None]


def test_custom_vars_keep_the_last_write(spark):
    rows = [(1, 4, "n", "old", 1), (1, 4, "n", "new", 2), (1, 5, "m", "x", 1), (2, 1, "d", "y", 1)]
    df = spark.createDataFrame(rows, "event_id INT, idx INT, name STRING, value STRING, position INT")
    got = {r.event_id: r.vars for r in legacy.collect_vars(df).collect()}
    assert got == {1: {"4": ["n", "new"], "5": ["m", "x"]}, 2: {"1": ["d", "y"]}}
    text = legacy.encode_custom_vars({"5": ("b", F.lit("2")), "4": ("a", F.lit("1")), "1": ("c", F.lit(None).cast("string"))})
    assert spark.range(1).select(text).first()[0] == '{"4":["a","1"],"5":["b","2"]}'


def test_device_info_with_varying_separators(spark):
    texts = ["{App_Name : My, App, App_Version : 1.2, OS_Version : 12.1, Platform : iPhone X, SDK_Version : 2.2.1}",
             "{App_Name : a, App_Version : b, OS_Version : c, Platform : d, SDK_Version : e, Push_ClientId: f, Push_Type: g}"]
    df = spark.createDataFrame([(t,) for t in texts], "device_info STRING")
    got = [tuple(r)[1:] for r in legacy.decode_device_info(df).collect()]
    assert got == [("My, App", "1.2", "12.1", "iPhone X", "2.2.1", None, None), tuple("abcdefg")]


def test_request_time_in_a_zone(spark):
    row = legacy.legacy_request_time(events(spark, (DAY + 61_001, "a", {"userId": ""})), "Asia/Kolkata").first()
    assert (row.h, row.m, row.s, row.cdt, row.uid) == ("5", "31", "1", "2024-01-01 00:01:01", None)
    assert 0 <= int(row.r) < 50000


def test_target_group_is_found_in_objects_and_text(spark):
    texts = ['{"target_group_id":7}', '{"a":{"b":{"target_group_id":"x"}}}', '{"a":"{\\"target_group_id\\":\\"y\\"}"}',
             '{"a":[{"target_group_id":1}]}', '{"a":{"b":{"c":{"d":{"target_group_id":1}}}}}', "no", None,
             '{"a":{"target_group_id":"deep"},"target_group_id":"top"}']
    df = spark.createDataFrame([(t,) for t in texts], "m STRING")
    got = [r.target_group_id for r in legacy.find_target_group(df, "m").collect()]
    assert got == ["7", "x", "y", None, "1", None, None, "top"]
    deep = '{"target_group_id":9}'
    for _ in range(9):
        deep = '{"o":' + deep + "}"
    df = spark.createDataFrame([(deep,), ('\n\t{"a":\n {"target_group_id":3}}',)], "m STRING")
    assert [r.target_group_id for r in legacy.find_target_group(df, "m").collect()] == ["9", "3"]


def test_bad_input_neither_stops_nor_loses_rows(spark):
    df = spark.createDataFrame([('{"5":["systemvariable","{Lifetime_seq:123456789012345678901234}"]}',)], "cvar STRING")
    assert legacy.parse_lifetime_seq(df).first().lifetime_seq is None
    rows = events(
        spark, (DAY, "login", {"userId": "u", "eventBody": "oops"}), (DAY, "login", {"userId": "u", "eventBody": '{"uid":"x"}'}),
        (DAY, None, {}), (DAY, "login", {"userId": "u", "eventBody": '\n {"a":1}'}),
    )
    assert [json.loads(r.e_n) if r.e_n else None for r in legacy.to_legacy(rows).orderBy("sn").collect()] == [
        {"uid": "u"}, {"uid": "x"}, {}, {"a": 1, "uid": "u"}]


def test_bridge_copies(spark):
    rows = events(spark, (DAY, "a", {"projectId": "p1"}), (DAY, "b", {"projectId": "p2", "siteId": None}), (DAY, "c", {"projectId": None}))
    both = bridge.bridge_info(bridge.bridge_fan_out(rows, "p1", "s9"))
    got = rows_of(both, "eventName", "projectId", "siteId", "sourceProjectId", "destProjectId", "dupFlag")
    assert got == [
        ("a", "p1", "s9", "p1", "p1", None), ("b", "p1", "s9", "p2", "p1", 1),
        ("b", "p2", "s9", "p2", "p1", 0), ("c", "p1", "s9", "p1", "p1", None)]
    alone = bridge.bridge_info(bridge.bridge_fan_out(rows, "p1", "s9", forward=False))
    assert rows_of(alone, "eventName", "dupFlag") == [("a", None), ("b", 1), ("c", None)]
    assert rows_of(bridge.drop_bridge_duplicates(both), "eventName", "projectId") == [("a", "p1"), ("b", "p2"), ("c", "p1")]


def test_sampling_is_repeatable_and_close_to_its_rate(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("deviceId"), F.lit(1).alias("sn"))
    for rate in (0, 50, 100):
        kept = filters.sample_events(df, rate)
        share = kept.count() / 20_000
        assert abs(share - (rate + 1) / 101) < 0.02
        assert kept.exceptAll(filters.sample_events(df, rate)).count() == 0


def test_denylists(spark):
    df = spark.createDataFrame([(SCREEN_DENYLIST[3], False), ("Mine", False), ("Ok", None), (None, False), ("Web", True)],
                               "screen STRING, has_web_view BOOLEAN")
    assert rows_of(filters.native_screens(df, ["Mine"]), "screen") == [("Ok",), (None,)]
    listed = spark.createDataFrame([("Mine",), ("Mine",)], "name STRING")
    assert rows_of(filters.screen_denylist(df, listed), "screen") == [("Ok",), ("Web",), (None,)]


def test_lookups(spark):
    assert (len(pairs(DEVICE_MODELS)), len(pairs(RADIO_LABELS))) == (72, 11)
    df = spark.createDataFrame([("iPhone10,3", "wwan", "CTRadioAccessTechnologyLTE"), ("New1,1", "wwan", "x"), (None, "none", None), ("i386", "wifi", None)],
                               "deviceCode STRING, reachability STRING, radio STRING")
    out = with_network_type(with_device_model(df))
    assert rows_of(out, "uaDevice", "netType") == [("New1,1", ""), ("Simulator", "Wifi"), ("iPhone X", "4G"), (None, "no network")]


def test_page_urls(spark):
    url = projections.build_page_url(F.lit("My App"), F.col("v"), F.col("u"), F.col("p"))
    df = spark.createDataFrame([("a", None, "x"), ("a?b=1", "c", None), ("a", "c", "x"), ("a", "", "x")], "v STRING, u STRING, p STRING")
    assert [r[0] for r in df.select(url).collect()] == [
        "http://My App/a", "http://My App/a?b=1&utm_campaign=c", "http://My App/a?utm_campaign=c&pushContent=x", "http://My App/a"]
