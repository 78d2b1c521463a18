from pyspark.sql import functions as F

from footfall.operators import bodies, clicks, commerce, filters
from footfall.plans import rebuild
from footfall.sources import sinks
from tests.conftest import rows_of
from tests.helpers import DAY, events


def orders(spark, *texts):
    return commerce.order_table(events(spark, *[(DAY + i, "order", {"eventBody": t}) for i, t in enumerate(texts)]))


INFO = '"orderInfo":{%s"orderAMT":"10.05","shipAMT":"0.06"}'


def test_empty_order_ids_are_dropped_and_missing_ones_kept(spark):
    rows = orders(spark, "{" + INFO % '"orderID":"",' + "}", "{" + INFO % "" + "}", "{" + INFO % '"orderID":"o1",' + "}")
    assert rows_of(filters.valid_order(rows), "orderID") == [("o1",), (None,)]


def test_line_tables(spark):
    rows = orders(
        spark,
        "{" + INFO % '"orderID":"o1",' + ',"productInfo":[{"sku":"a","productCategory":"","productRealPrice":"1.10",'
        '"productOriPrice":"-1.00","productQuantity":2},{"productTitle":"t","productOriPrice":"2.00"}],'
        '"couponInfo":[{"couponAMT":"0.50"}]}',
        "{" + INFO % '"orderID":"o2",' + "}",
    )
    products = commerce.order_products(rows)
    got = rows_of(products.select("orderID", "line", "sku", F.col("productOriPrice").cast("string"), "productQuantity"))
    assert got == [("o1", 0, "a", None, 2), ("o1", 1, None, "2.00", None), ("o2", None, None, None, None)]
    coupons = commerce.order_coupons(rows).select("orderID", "couponType", F.col("couponAMT").cast("string"))
    assert rows_of(coupons) == [("o1", None, "0.50"), ("o2", None, None)]
    items = commerce.legacy_order_items(rows).select("ec_items", "ec_st", "ec_id")
    # neither product has both a sku and a title
    assert rows_of(items) == [(None, "9.99", "o1"), (None, "9.99", "o2")]


def test_bad_bodies_give_nulls(spark):
    (row,) = orders(spark, "{broken").collect()
    assert row.orderID is None and row.orderAMT is None and row.productInfo is None


def test_legacy_items_are_quoted_as_json(spark):
    body = '{"productInfo":[{"sku":"a\\"b","productTitle":"t","productRealPrice":"3.00","productQuantity":2}]}'
    rows = commerce.legacy_order_items(orders(spark, body))
    assert rows.first().ec_items == '[["sku:a\\"b","t","","3.00",2]]'
    (item,) = commerce.decode_legacy_items(rows.select("ec_items")).collect()
    assert (item.sku, item.title, str(item.price), item.quantity, item.ambiguous) == ('a"b', "t", "3.00", 2, False)


def test_items_with_skipped_fields_are_ambiguous(spark):
    df = spark.createDataFrame([('[["sku:1","n","8,900.00","2"],["sku:2","n","c","8,900.00","2"]]',)], "ec_items STRING")
    got = commerce.decode_legacy_items(df).orderBy("line").collect()
    assert [r.ambiguous for r in got] == [True, False]
    assert got[0].raw == ["sku:1", "n", "8,900.00", "2"] and got[0].sku is None
    assert str(got[1].price) == "8900.00"


def test_valid_transactions(spark):
    item = "named_struct('sku', {})"
    df = spark.sql(f"""
      SELECT 1 AS i, 'a' AS identifier, 1.0 AS grandTotal, array({item.format("'x'")}) AS items
      UNION ALL SELECT 2, '', 1.0, array({item.format("'x'")})
      UNION ALL SELECT 3, 'a', NULL, array({item.format("'x'")})
      UNION ALL SELECT 4, 'a', 1.0, array({item.format("'x'")}, {item.format("''")})
      UNION ALL SELECT 5, 'a', 1.0, array({item.format("CAST(NULL AS STRING)")})
      UNION ALL SELECT 6, 'a', 1.0, NULL""")
    assert rows_of(filters.valid_transaction(df), "i") == [(1,), (6,)]


def test_custom_names_must_match_as_a_whole(spark):
    names = ["abc_1", "a b", "a\n", "", "ä", None, "9"]
    df = spark.createDataFrame([(n,) for n in names], "eventName STRING")
    assert rows_of(filters.valid_custom_name(df)) == [("9",), ("abc_1",)]


def test_push_needs_a_recipient(spark):
    rows = bodies.parse_push(events(
        spark,
        (DAY, "jPush", {"eventBody": '{"pushInfo":{"tag":"t"}}'}),
        (DAY, "jPush", {"eventBody": '{"pushInfo":{}}'}),
        (DAY, "jPush"),
    ))
    (row,) = filters.valid_push(rows).collect()
    assert (row.tag, row.pushContent, row.dcid, row.dtg) == ("t", "", 0, 0)


def test_flags_and_money(spark):
    rows = events(spark, (DAY, "payment", {"eventBody": '{"payStatus":1,"payAMT":"1.005"}'}),
                  (DAY, "payment", {"eventBody": '{"payStatus":0}'}))
    got = bodies.parse_payment(rows).orderBy("sn").collect()
    assert [r.payStatus for r in got] == [True, False]
    assert got[1].payAMT is None


def test_h5_bodies_may_be_objects_or_text(spark):
    texts = ['{"eventName":"x","eventBody":{"a":1}}', '{"eventName":"x","eventBody":"{\\"a\\":1}"}',
             '{"eventBody":"nope"}', '[1]', 'x', None]
    df = spark.createDataFrame([(t,) for t in texts], "message STRING")
    got = rows_of(bodies.parse_h5(df), "eventName", "eventBody")
    assert got == [("", "{}"), ("x", '{"a":1}'), ("x", '{"a":1}')]
    good, bad = filters.reject_malformed(df)
    assert (good.count(), bad.count()) == (3, 3)


def test_click_table(spark):
    path = "Win/UITableViewWrapperView/Cell[3]/UITableViewWrapperView/UIButton"
    rows = events(
        spark,
        (DAY, "click", {"url": "u", "eventBody": '{"eType":"b","ePath":"%s","ePosition":"2:5"}' % path}),
        (DAY, "click", {"url": "u", "eventBody": '{"ePosition":"7","id":"given"}'}),
    )
    one, two = clicks.click_table(rows).orderBy("sn").collect()
    assert one.ePath == "Win/Cell[3]/UITableViewWrapperView/UIButton"
    assert [(n.cls, n.idx) for n in one.nodes][:2] == [("Win", None), ("Cell", 3)]
    assert (one.section, one.row, two.section, two.row, two.id) == (2, 5, None, 7, "given")
    assert len(one.id) == 16


def test_element_text(spark):
    kids = [(1, 2, "label", "b", None, False), (1, 1, "button", "a", None, None), (1, 3, "label", "", None, False),
            (1, 4, "label", "x", None, True), (2, 1, "switch", None, 1.0, False), (2, 2, "stepper", None, 12.50, False),
            (2, 3, "slider", None, 0.5, False), (2, 4, "stepper", None, 3.0, False)]
    df = spark.createDataFrame(kids, "element_id INT, child_no INT, kind STRING, text STRING, number DOUBLE, hidden BOOLEAN")
    assert rows_of(clicks.element_text(df)) == [(1, "a-b"), (2, "checked-12.5-0.500000-3")]


def test_stepper_numbers_are_written_like_g(spark):
    from footfall.operators.clicks import element_text

    numbers = [0.0005, 2_000_000.0, 12.5, 3.0, 0.0, 0.00001234, 123456.0, 1234567.0, 100.0, -0.25]
    rows = spark.createDataFrame([(i, 1, "stepper", None, n, False) for i, n in enumerate(numbers)],
                                 "element_id INT, child_no INT, kind STRING, text STRING, number DOUBLE, hidden BOOLEAN")
    assert [r.eContent for r in element_text(rows).orderBy("element_id").collect()] == ["%g" % n for n in numbers]


def test_legacy_table_has_a_row_with_the_items_of_an_order(spark):
    product = '{"sku":"a","productTitle":"t","productRealPrice":"1.10","productQuantity":2}'
    body = "{" + INFO % '"orderID":"o1",' + ',"productInfo":[%s]}'
    rows = events(
        spark, (DAY, "pageview", {"url": "u"}), (DAY + 1, "order", {"eventBody": body % product}),
        (DAY + 2, "order", {"eventBody": body % ""}), (DAY + 3, "order", {"eventBody": "oops"}), (DAY + 4, None),
    )
    for legacy in (rebuild.legacy_table(rows), sinks.legacy_rows(rows)):
        got = rows_of(legacy, "sn", "e_a", "e_n", "ec_items", "ec_id", "revenue", "ec_sh", "ec_st", "idgoal", "cvar", "idsite")
        assert len(got) == 6
        (item,) = [r for r in got if r[3]]
        assert item[1:9] == ("order", "", '[["sku:a","t","","1.10",2]]', "o1", "10.05", "0.06", "9.99", "0")
        assert item[9] is None and item[10] == "s1" and item[0] == 2
        assert all(r[3:9] == (None,) * 6 and r[9] for r in got if not r[3])
