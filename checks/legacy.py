"""The legacy protocol."""

from pyspark.sql import functions as F

from checks import check
from checks.fixtures import LINE_BODY, LINE_ORDER_ID, LINES_SQL, RAW_SQL, TRACK_SQL, order_events, raw, spread, track
from checks.windows import UP, V1_SQL, _STATE, _VISITS_SQL
from footfall.operators import commerce, legacy
from footfall.plans import rebuild
from footfall.scratch import new_dir
from footfall.sources.sinks import fan_out

_LANDED_URL = "CASE WHEN k % 20 = 0 THEN url || '&utm_campaign=c' ELSE url END"

LEGACY_SQL = f"""
legacy AS (SELECT event_id, siteId, deviceId, eventTime, sn, k,
  CASE WHEN eventName NOT IN ('pageview', 'search') THEN 'event1.0' END AS e_c,
  CASE WHEN eventName <> 'search' THEN eventName END AS e_a,
  CASE WHEN eventName = 'login' THEN '{{"uid":"' || userId || '"}}' WHEN eventName NOT IN ('pageview', 'search') THEN eventBody END AS e_n,
  CASE WHEN eventName = 'search' THEN 'kw' || k END AS search,
  title AS action_name, title, {_LANDED_URL} AS url,
  CASE WHEN eventName = 'pageview' AND k % 20 = 0 THEN '1' END AS new_visit,
  CASE WHEN eventName = 'pageview' AND k % 2 = 0 THEN '[{{keyName:k, keyValue:' || k || '}}]' END AS customvariable,
  '0' AS ec_tx
FROM track WHERE eventName NOT IN ('initJPush', 'jPush', 'openChannel'))"""

_FIELDS = ("e_c", "e_a", "e_n", "search", "action_name", "title", "url", "new_visit", "customvariable", "ec_tx")


def mapped(spark, sf):
    rows = spread(track(spark, sf, "event_id", "k", *_STATE, "url", "title", "userId"), "event_id")
    tagged = F.when(F.col("k") % 20 == 0, F.concat("url", F.lit("&utm_campaign=c")))
    return legacy.to_legacy(rows.withColumn("url", F.coalesce(tagged, "url")))


@check("prj6_to_legacy", f"WITH {TRACK_SQL}, {LEGACY_SQL} SELECT event_id, {', '.join(_FIELDS)} FROM legacy")
def to_legacy(spark, sf):
    return mapped(spark, sf).select("event_id", *_FIELDS)


@check("prj6_to_legacy_orders", f"""WITH {LINES_SQL}
SELECT CAST(ok * 10 + ln AS BIGINT) AS sn, 'order' AS e_a, 'event1.0' AS e_c, '' AS e_n, '0' AS idgoal,
  {LINE_ORDER_ID} AS ec_id, CAST(amt AS VARCHAR) AS revenue, CAST(ship AS VARCHAR) AS ec_sh
FROM lines WHERE ln < 5 AND (pk % 5 <> 0 OR qty > 25)""")
def to_legacy_orders(spark, sf):
    """Item rows: only orders with at least one usable product, without a body."""
    orders = commerce.legacy_order_items(commerce.order_table(order_events(spark, sf)))
    orders = orders.where("ec_items IS NOT NULL").withColumns(
        {"eventName": F.lit("order"), "eventBody": F.lit(None).cast("string")})
    rows = legacy.to_legacy(orders)
    return rows.select(F.col("sn").cast("bigint").alias("sn"), "e_a", "e_c", "e_n", "idgoal", "ec_id", "revenue", "ec_sh")


_SHANGHAI = "(eventTime // 1000 + 28800)"


@check("prj7_request_time", f"""WITH {TRACK_SQL}
SELECT event_id, CAST({_SHANGHAI} // 3600 % 24 AS VARCHAR) AS h, CAST({_SHANGHAI} // 60 % 60 AS VARCHAR) AS m,
  CAST({_SHANGHAI} % 60 AS VARCHAR) AS s,
  strftime(make_timestamp(eventTime // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS cdt, userId AS uid,
  CAST(('0x' || substr(md5(deviceId || ':' || eventTime || ':' || CAST(sn AS BIGINT)), 1, 8))::BIGINT % 50000 AS VARCHAR) AS r
FROM track""")
def request_time(spark, sf):
    rows = legacy.legacy_request_time(track(spark, sf, "event_id", *_STATE, "userId"), "Asia/Shanghai")
    return rows.select("event_id", "h", "m", "s", "cdt", "uid", "r")


@check("prj8_static", f"""WITH {RAW_SQL}
SELECT event_id, siteId AS idsite, '1' AS rec, '1' AS apiv,
  CASE WHEN k % 2 = 0 THEN '1125x2436' ELSE '828x1792' END AS res, deviceId AS _id, '0' AS send_image FROM raw""")
def static(spark, sf):
    rows = legacy.legacy_static(raw(spark, sf))
    return rows.select("event_id", "idsite", "rec", "apiv", "res", "_id", "send_image")


CVAR_SQL = """
CASE WHEN customvariable IS NOT NULL OR search IS NULL THEN '{' || concat_ws(',',
  '"4":["customvariable","' || customvariable || '"]',
  CASE WHEN search IS NULL THEN '"5":["systemvariable","{Lifetime_seq:' || CAST(sn AS BIGINT) || '}"]' END) || '}' END"""


@check("prj11_custom_vars", f"""WITH {TRACK_SQL}, {LEGACY_SQL}
SELECT event_id, {CVAR_SQL} AS cvar, customvariable,
  CASE WHEN search IS NULL THEN '{{Lifetime_seq:' || CAST(sn AS BIGINT) || '}}' END AS systemvariable FROM legacy""")
def custom_vars(spark, sf):
    rows = legacy.request_vars(mapped(spark, sf)).select("event_id", "cvar")
    return legacy.decode_custom_vars(rows).select("event_id", "cvar", "customvariable", "systemvariable")


@check("prj12_custom_dimension", """
SELECT p_partkey, p_name AS name, p_brand AS brand, CASE WHEN p_size % 2 = 0 THEN p_type END AS kind, CAST(NULL AS VARCHAR) AS other FROM part""")
def custom_dimension(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    given = F.expr("""map_filter(map('name', p_name, 'brand', p_brand, 'kind', CASE WHEN p_size % 2 = 0 THEN p_type END),
                      (k, v) -> v IS NOT NULL)""")
    rows = part.select("p_partkey", legacy.encode_dimension(given).alias("customvariable"))
    dimension = F.col("dimension")
    return legacy.decode_custom_dimension(rows).select(
        "p_partkey", *[dimension[n].alias(n) for n in ("name", "brand", "kind", "other")])


@check("prj13_lifetime_seq", f"""WITH {TRACK_SQL}, {LEGACY_SQL}
SELECT event_id, CASE WHEN search IS NULL THEN CAST(sn AS BIGINT) END AS lifetime_seq FROM legacy""")
def lifetime_seq(spark, sf):
    rows = legacy.parse_lifetime_seq(legacy.request_vars(mapped(spark, sf)))
    return rows.select("event_id", F.col("lifetime_seq").cast("bigint").alias("lifetime_seq"))


@check("prj24_device_info", f"""WITH {RAW_SQL}
SELECT event_id, 'My, App' AS app_name, appVersion AS app_version, osVersion AS os_version, 'iPhone X' AS platform,
  '2.2.1' AS sdk_version, CASE WHEN k % 2 = 0 THEN 'id' || k END AS push_client_id,
  CASE WHEN k % 2 = 0 THEN 'apns' END AS push_type FROM raw""")
def device_info(spark, sf):
    rows = raw(spark, sf)
    pushed = F.col("k") % 2 == 0
    info = legacy.encode_device_info({
        "App_Name": F.lit("My, App"), "App_Version": F.col("appVersion"), "OS_Version": F.col("osVersion"),
        "Platform": F.lit("iPhone X"), "SDK_Version": F.lit("2.2.1"),
        "Push_ClientId": F.when(pushed, F.concat(F.lit("id"), F.col("k").cast("string"))),
        "Push_Type": F.when(pushed, F.lit("apns")),
    })
    return legacy.decode_device_info(rows.select("event_id", info.alias("device_info"))).drop("device_info")


@check("prj26_category_event", f"""WITH {TRACK_SQL},
seen AS (SELECT *, coalesce(last_value(url IGNORE NULLS) OVER {UP}, 'http://app') AS u FROM track)
SELECT event_id, 'custom' AS e_c, eventName AS e_a, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END AS e_n,
  CAST(NULL AS VARCHAR) AS e_v, u AS url FROM seen WHERE eventName IN ('error', 'bad name')""")
def category_event(spark, sf):
    rows = legacy.legacy_category_event(
        track(spark, sf, "event_id", "k", *_STATE, "url"), F.lit("app"), F.lit("custom"), F.col("eventName"),
        name=F.when(F.col("k") % 2 == 0, F.col("k").cast("string")),
        when=F.col("eventName").isin("error", "bad name"))
    return rows.select("event_id", "e_c", "e_a", "e_n", "e_v", "url")


@check("evt17_transaction", """
SELECT o_orderkey, 'o' || o_orderkey AS identifier FROM orders WHERE o_orderkey % 3 < 2 AND o_orderstatus <> 'P'""")
def transaction(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    screens = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'OrderCreation' WHEN 1 THEN 'screen/OrderCreation' ELSE 'Other' END")
    dimension = F.expr("""CASE WHEN o_orderstatus <> 'P' THEN map('OrderId', 'o' || o_orderkey, 'kind', o_orderpriority)
                          ELSE map('kind', o_orderpriority) END""")
    cvar = legacy.encode_custom_vars({"4": ("customvariable", legacy.encode_dimension(dimension))})
    rows = orders.select("o_orderkey", screens.alias("action_name"), cvar.alias("cvar"))
    return commerce.parse_transaction(rows).select("o_orderkey", "identifier")


LEGACY_TABLE_SQL = f"""WITH {TRACK_SQL}, {LEGACY_SQL},
landed AS (SELECT * FROM track WHERE eventName NOT IN ('initJPush', 'jPush', 'openChannel')), {V1_SQL}, {_VISITS_SQL}
SELECT l.event_id, l.siteId AS idsite, l.deviceId AS _id, l.e_a, l.url, {CVAR_SQL.replace("CAST(sn", "CAST(l.sn")} AS cvar,
  strftime(make_timestamp(l.eventTime // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS cdt,
  CASE WHEN a.new_visit THEN '1' END AS new_visit, CAST(a.n AS VARCHAR) AS _idvc,
  CAST(b.earlier // 1000 AS VARCHAR) AS _viewts, CAST(b.first_start // 1000 AS VARCHAR) AS _idts
FROM numbered a JOIN visits b USING (projectId, siteId, deviceId, n) JOIN legacy l ON l.event_id = a.event_id"""
_LEGACY = ("event_id", "idsite", "_id", "e_a", "url", "cvar", "cdt", "new_visit", "_idvc", "_viewts", "_idts")


def _landing(spark, sf):
    rows = track(spark, sf, "event_id", "k", *_STATE, "url", "title", "userId")
    tagged = F.when(F.col("k") % 20 == 0, F.concat("url", F.lit("&utm_campaign=c")))
    return rows.withColumn("url", F.coalesce(tagged, "url"))


@check("plan_legacy_table", LEGACY_TABLE_SQL)
def legacy_table(spark, sf):
    return rebuild.legacy_table(_landing(spark, sf)).select(*_LEGACY)


@check("snk3_fan_out_visits", LEGACY_TABLE_SQL)
def fan_out_visits(spark, sf):
    """Three epochs, each counting visits on from the one before; the last one is replayed."""
    rows, old = _landing(spark, sf), new_dir(spark, "legacy")
    cuts = [0, 1704500000000, 1705300000000, 10**14]
    for epoch in (0, 1, 2, 2):
        part = rows.where((F.col("eventTime") >= cuts[epoch]) & (F.col("eventTime") < cuts[epoch + 1]))
        fan_out(part, new_dir(spark, "current"), old, epoch)
    return spark.read.parquet(old).select(*_LEGACY)


@check("plan_legacy_orders", f"""WITH {LINES_SQL},
parts AS (SELECT *,
  CASE WHEN ln < 5 AND pk % 5 <> 0 THEN '["sku:p' || pk || '","t' || pk || '","c' || (pk % 5) || '","' || CAST(amt - ship AS DECIMAL(18,2)) || '",' || qty || ']' END AS one,
  CASE WHEN ln < 5 AND qty > 25 THEN '["sku:g' || sk || '","gift","","1.00",1]' END AS two FROM lines),
numbered AS (SELECT *, CAST(ok * 10 + ln AS BIGINT) AS sn FROM parts)
SELECT sn, 's1' AS idsite, 'order' AS e_a, {LINE_BODY} AS e_n, NULL AS ec_id, NULL AS ec_items, NULL AS revenue, NULL AS ec_sh,
  NULL AS ec_st, NULL AS idgoal, '{{"5":["systemvariable","{{Lifetime_seq:' || sn || '}}"]}}' AS cvar FROM numbered
UNION ALL SELECT sn, 's1', 'order', '', {LINE_ORDER_ID}, '[' || concat_ws(',', one, two) || ']',
  CAST(amt AS VARCHAR), CAST(ship AS VARCHAR), CAST(CAST(amt - ship AS DECIMAL(18,2)) AS VARCHAR), '0', NULL
FROM numbered WHERE one IS NOT NULL OR two IS NOT NULL""")
def legacy_table_of_orders(spark, sf):
    """An order gives its own row and, with usable products, a second one that holds the revenue."""
    absent = {c: F.lit(None).cast("string") for c in ("url", "title", "userId")}
    rows = rebuild.legacy_table(order_events(spark, sf).withColumns(absent))
    return rows.select(F.col("sn").cast("bigint").alias("sn"), "idsite", "e_a", "e_n", "ec_id", "ec_items",
                       "revenue", "ec_sh", "ec_st", "idgoal", "cvar")
