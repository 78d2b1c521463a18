"""Typed event bodies."""

from functools import reduce

from pyspark.sql import functions as F

from checks import check
from checks.fixtures import LINE_BODY, LINE_ORDER_ID, LINES_SQL, TRACK_SQL, order_events, spread, track
from footfall.operators import bodies, commerce

_BODY_COLUMNS = ("projectId", "siteId", "deviceId", "eventTime", "sn", "eventName", "eventBody",
                 "url", "title", "userId")


def _events(spark, sf):
    return track(spark, sf, *_BODY_COLUMNS)


def _twin(name: str, columns: str) -> str:
    return f"""WITH {TRACK_SQL}
SELECT deviceId, CAST(sn AS BIGINT) AS sn, {columns} FROM track WHERE eventName = '{name}'"""


def _flat(df, *columns):
    return df.select("deviceId", F.col("sn").cast("bigint").alias("sn"), *columns)


def _dbl(name):
    return F.col(name).cast("double").alias(name)


@check("evt1_pageview", _twin("pageview", """url, title,
  CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END AS ud_k"""))
def pageview(spark, sf):
    rows = bodies.parse_pageview(_events(spark, sf))
    return _flat(rows, "url", "title", F.col("udVariable")["k"].alias("ud_k"))


@check("evt2_search", _twin("search", """'kw' || k AS keyword,
  k % 2 = 1 AS recommendationSearchFlag, k % 3 % 2 = 1 AS historySearchFlag"""))
def search(spark, sf):
    rows = bodies.parse_search(_events(spark, sf))
    return _flat(rows, "keyword", "recommendationSearchFlag", "historySearchFlag")


@check("evt3_product_page", _twin("productPage", """'s' || k AS sku, 'c' || (k % 5) AS productCategory1,
  CASE WHEN k % 2 = 0 THEN 'd' || (k % 3) END AS productCategory2, CAST(NULL AS VARCHAR) AS productCategory3,
  CAST(CAST(v + 1 AS DECIMAL(18,2)) AS DOUBLE) AS productOriginalPrice, CAST(v AS DOUBLE) AS productRealPrice"""))
def product_page(spark, sf):
    rows = bodies.parse_product_page(_events(spark, sf))
    return _flat(rows, "sku", "productCategory1", "productCategory2", "productCategory3",
                 _dbl("productOriginalPrice"), _dbl("productRealPrice"))


@check("evt4_add_cart", _twin("addCart", """'s' || k AS sku, CAST(k AS BIGINT) AS productQuantity,
  CAST(v AS DOUBLE) AS productRealPrice"""))
def add_cart(spark, sf):
    rows = bodies.parse_add_cart(_events(spark, sf))
    return _flat(rows, "sku", "productQuantity", _dbl("productRealPrice"))


@check("evt5_order", f"""WITH {LINES_SQL}
SELECT CAST(ok * 10 + ln AS BIGINT) AS sn, {LINE_ORDER_ID} AS orderID, CAST(amt AS DOUBLE) AS orderAMT,
  CAST(ship AS DOUBLE) AS shipAMT, CAST(NULL AS VARCHAR) AS shipAddress,
  CASE WHEN pk % 2 = 0 THEN 'air' END AS shipMethod,
  CASE WHEN disc > 0 THEN CASE WHEN qty > 40 THEN 2 ELSE 1 END ELSE 0 END AS n_coupons,
  CASE WHEN ln < 5 THEN CASE WHEN qty > 25 THEN 2 ELSE 1 END ELSE 0 END AS n_products
FROM lines""")
def order(spark, sf):
    rows = commerce.order_table(order_events(spark, sf))
    return rows.select(
        F.col("sn").cast("bigint").alias("sn"), "orderID", _dbl("orderAMT"), _dbl("shipAMT"),
        "shipAddress", "shipMethod",
        F.coalesce(F.size("couponInfo"), F.lit(0)).alias("n_coupons"),
        F.coalesce(F.size("productInfo"), F.lit(0)).alias("n_products"),
    )


@check("evt6_payment", _twin("payment", """CAST(event_id AS VARCHAR) AS orderID, 'card' AS payMethod,
  k % 2 = 1 AS payStatus, CAST(v AS DOUBLE) AS payAMT"""))
def payment(spark, sf):
    rows = bodies.parse_payment(_events(spark, sf))
    return _flat(rows, "orderID", "payMethod", "payStatus", _dbl("payAMT"))


@check("evt7_pre_charge", _twin("preCharge", """CAST(v AS DOUBLE) AS chargeAMT, 'wallet' AS chargeMethod,
  k % 2 = 1 AS payStatus, CAST(0.5 AS DOUBLE) AS couponAMT"""))
def pre_charge(spark, sf):
    rows = bodies.parse_pre_charge(_events(spark, sf))
    return _flat(rows, _dbl("chargeAMT"), "chargeMethod", "payStatus", _dbl("couponAMT"))


@check("evt8_register", _twin("register", """'u' || user_id AS uid,
  CASE WHEN k % 3 = 0 THEN 'phone' END AS type, k % 2 = 1 AS authenticated, userId"""))
def register(spark, sf):
    rows = bodies.parse_register(_events(spark, sf))
    return _flat(rows, "uid", "type", "authenticated", "userId")


@check("evt9_login", _twin("login", "userId, CAST(NULL AS VARCHAR) AS registrationID"))
def login(spark, sf):
    return _flat(bodies.parse_login(_events(spark, sf)), "userId", "registrationID")


@check("evt10_logout", _twin("logout", "CAST(k AS VARCHAR) AS ud_k"))
def logout(spark, sf):
    rows = bodies.parse_logout(_events(spark, sf))
    return _flat(rows, F.col("udVariable")["k"].alias("ud_k"))


@check("evt11_custom", f"""WITH {TRACK_SQL}
SELECT deviceId, CAST(sn AS BIGINT) AS sn, eventName, CAST(k AS VARCHAR) AS level
FROM track WHERE eventName IN ('error', 'bad name')""")
def custom(spark, sf):
    rows = bodies.parse_custom(_events(spark, sf))
    return _flat(rows, "eventName", F.col("vars")["level"].alias("level"))


@check("evt12_click", _twin("click", """
  CASE WHEN k % 3 = 0 THEN 'UITableView' ELSE 'UIButton' END AS eType,
  'Win/UITableViewWrapperView/View[' || k || ']/UITableViewWrapperView/UIButton' AS ePath,
  CASE WHEN k % 2 = 0 THEN (k % 10) || ':' || (k % 7) WHEN k % 3 = 0 THEN CAST(k % 4 AS VARCHAR) END AS ePosition,
  'c' || k AS eContent"""))
def click(spark, sf):
    return _flat(bodies.parse_click(_events(spark, sf)), "eType", "ePath", "ePosition", "eContent")


@check("evt13_push", _twin("jPush", """CASE WHEN k % 2 = 1 THEN 'a' || k END AS alias,
  CASE WHEN k % 5 = 0 THEN '' ELSE 'msg ' || k END AS pushContent, k % 3 AS dcid, k % 2 AS dtg"""))
def push(spark, sf):
    return _flat(bodies.parse_push(_events(spark, sf)), "alias", "pushContent", "dcid", "dtg")


@check("evt14_init_push", _twin("initJPush", "'r' || k AS registrationID"))
def init_push(spark, sf):
    rows = bodies.parse_init_push(_events(spark, sf))
    return _flat(rows, F.col("pushManager")["registrationID"].alias("registrationID"))


@check("evt15_open_channel", _twin("openChannel", """
  CASE WHEN k = 0 THEN '' ELSE 'ch' || k END AS openChannelName"""))
def open_channel(spark, sf):
    return _flat(bodies.parse_open_channel(_events(spark, sf)), "openChannelName")


@check("evt16_order_products", f"""WITH {LINES_SQL},
first_line AS (
  SELECT ok, ln, CASE WHEN ln < 5 THEN 0 END AS line, CASE WHEN ln < 5 THEN 'p' || pk END AS sku,
    CASE WHEN ln < 5 THEN 'c' || (pk % 5) END AS productCategory,
    CASE WHEN ln < 5 THEN CAST(CAST(amt - ship AS DECIMAL(18,2)) AS DOUBLE) END AS productRealPrice,
    CASE WHEN ln < 5 AND pk % 4 <> 0 THEN CAST(amt AS DOUBLE) END AS productOriPrice,
    CASE WHEN ln < 5 THEN CAST(qty AS BIGINT) END AS productQuantity,
    CASE WHEN ln < 5 AND pk % 5 <> 0 THEN 't' || pk END AS productTitle FROM lines),
gift AS (
  SELECT ok, ln, 1, 'g' || sk, '', CAST(1.0 AS DOUBLE), CAST(NULL AS DOUBLE), CAST(1 AS BIGINT), 'gift'
  FROM lines WHERE ln < 5 AND qty > 25)
SELECT CAST(ok * 10 + ln AS BIGINT) AS sn, * EXCLUDE (ok, ln) FROM (SELECT * FROM first_line UNION ALL SELECT * FROM gift)""")
def order_products(spark, sf):
    rows = commerce.order_products(commerce.order_table(order_events(spark, sf)))
    return rows.select(
        F.col("sn").cast("bigint").alias("sn"), "line", "sku", "productCategory",
        _dbl("productRealPrice"), _dbl("productOriPrice"), "productQuantity", "productTitle",
    )


@check("evt16_order_coupons", f"""WITH {LINES_SQL},
one AS (SELECT ok, ln, CASE WHEN disc > 0 THEN 0 END AS line, CASE WHEN disc > 0 THEN 'discount' END AS couponType,
  CASE WHEN disc > 0 THEN CAST(disc AS DOUBLE) END AS couponAMT FROM lines),
two AS (SELECT ok, ln, 1, CAST(NULL AS VARCHAR), CAST(1.0 AS DOUBLE) FROM lines WHERE disc > 0 AND qty > 40)
SELECT CAST(ok * 10 + ln AS BIGINT) AS sn, * EXCLUDE (ok, ln) FROM (SELECT * FROM one UNION ALL SELECT * FROM two)""")
def order_coupons(spark, sf):
    rows = commerce.order_coupons(commerce.order_table(order_events(spark, sf)))
    return rows.select(F.col("sn").cast("bigint").alias("sn"), "line", "couponType", _dbl("couponAMT"))


@check("evt18_h5", f"""WITH {TRACK_SQL}
SELECT event_id, 'pageview' AS eventName, 'page ' || k AS title, 'http://h5/' || k AS url,
  CASE WHEN k % 3 = 0 THEN 'p2' ELSE 'p1' END AS projectId, CASE WHEN k % 2 = 0 THEN 's9' END AS siteId,
  CASE WHEN k % 7 = 0 THEN '{{}}' ELSE '{{"a":' || k || '}}' END AS eventBody
FROM track WHERE k % 11 <> 0""")
def h5(spark, sf):
    rows = bodies.parse_h5(h5_messages(spark, sf))
    return rows.select("event_id", "eventName", "title", "url", "projectId", "siteId", "eventBody")


def h5_messages(spark, sf):
    """Messages of embedded pages; some are no objects, and the body is an
    object in some and its text in others."""
    rows = spread(track(spark, sf, "event_id", "k", "deviceId", "eventTime", "sn"), "event_id")
    return rows.withColumn(
        "message",
        F.expr("""
        CASE WHEN k % 11 = 0 THEN CASE WHEN k % 2 = 0 THEN '["no"]' ELSE '{broken' END
        ELSE '{"eventName":"pageview","title":"page ' || k || '","url":"http://h5/' || k
          || '","projectId":"' || CASE WHEN k % 3 = 0 THEN 'p2' ELSE 'p1' END || '"'
          || CASE WHEN k % 2 = 0 THEN ',"siteId":"s9"' ELSE '' END
          || CASE WHEN k % 7 = 0 THEN '' WHEN k % 5 = 0 THEN ',"eventBody":"{\\\\"a\\\\":' || k || '}"'
             ELSE ',"eventBody":{"a":' || k || '}' END || '}' END"""),
    )


_ENCODED = ("pageview", "search", "productPage", "addCart", "payment", "preCharge", "register", "logout", "click",
            "jPush", "initJPush", "openChannel")


@check("evt_encode", f"""WITH {TRACK_SQL}, {LINES_SQL}
SELECT CAST(sn AS BIGINT) AS sn, eventName, eventBody FROM track WHERE eventName IN {_ENCODED}
UNION ALL SELECT CAST(ok * 10 + ln AS BIGINT), 'order', {LINE_BODY} FROM lines""")
def encode(spark, sf):
    """Every body parsed and written again."""
    events = _events(spark, sf)
    parsed = [bodies.encode(bodies.parse(events, name, keep=("sn",)), name) for name in _ENCODED]
    parsed.append(bodies.encode(bodies.parse_order(order_events(spark, sf), keep=("sn",)), "order"))
    rows = reduce(lambda a, b: a.unionByName(b), parsed)
    return rows.select(F.col("sn").cast("bigint").alias("sn"), "eventName", "eventBody")
