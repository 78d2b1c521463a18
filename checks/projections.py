"""Projections."""

from pyspark.sql import functions as F

from checks import check
from checks.bodies import h5_messages
from checks.fixtures import (
    LINE_ORDER_ID, LINES_SQL, RAW_SQL, TRACK_SQL, order_events, raw, track,
)
from footfall.operators import bridge, clicks, commerce, legacy, projections, sessions
from footfall.operators.bodies import parse_click
from footfall.sources.wire import escape_params, unescape_params


@check("prj1_identity", f"""WITH {RAW_SQL}
SELECT event_id, nullif(trim(projectId), '') AS projectId, siteId, deviceId, nullif(userId, '') AS userId,
  userProperty, TRY_CAST(eventTime AS BIGINT) AS eventTime, CAST(TRY_CAST(sn AS DECIMAL(20,0)) AS VARCHAR) AS sn FROM raw""")
def identity(spark, sf):
    rows = projections.project_identity(raw(spark, sf))
    return rows.select("event_id", "projectId", "siteId", "deviceId", "userId", "userProperty",
                       "eventTime", F.col("sn").cast("string").alias("sn"))


@check("prj2_device", f"""WITH {RAW_SQL}
SELECT event_id, 'iOS' AS uaOs, split_part(osVersion, '.', 1) AS uaOsMajor,
  CASE WHEN k % 7 > 0 THEN split_part(osVersion, '.', 2) END AS uaOsMinor,
  nullif(uaName, '""') AS uaName, nullif(uaMajor, '""') AS uaMajor,
  CASE WHEN k % 3 > 0 THEN CAST(k AS VARCHAR) END AS uaRevision,
  CAST(375 + k % 2 * 39 AS VARCHAR) || '*' || CAST(812 + k % 2 * 84 AS VARCHAR) AS resolution,
  CASE k % 4 WHEN 2 THEN 'Wifi' WHEN 3 THEN '4G' END AS netType, language FROM raw""")
def device(spark, sf):
    rows = projections.project_device(raw(spark, sf))
    return rows.select("event_id", "uaOs", "uaOsMajor", "uaOsMinor", "uaName", "uaMajor",
                       "uaRevision", "resolution", "netType", "language")


@check("prj3_geo", f"""WITH {RAW_SQL}
SELECT event_id, CASE WHEN lat IS NOT NULL AND lgt IS NOT NULL THEN CAST(lat AS DOUBLE) END AS lat,
  CASE WHEN lat IS NOT NULL AND lgt IS NOT NULL THEN CAST(lgt AS DOUBLE) END AS lgt FROM raw""")
def geo(spark, sf):
    return projections.project_geo(raw(spark, sf)).select("event_id", "lat", "lgt")


@check("prj4_version", f"""WITH {RAW_SQL}
SELECT event_id, CASE WHEN k % 6 > 0 THEN '2.1.' || k END AS appVersion,
  CASE WHEN k % 6 > 0 THEN '2.2.1' END AS sdkVersion,
  '{{"appVersion":"' || appVersion || '","sdkVersion":"9.9"}}' AS customerVar FROM raw""")
def version(spark, sf):
    rows = raw(spark, sf).withColumnRenamed("appVersion", "installed")
    rows = projections.project_version(rows)
    return projections.encode_version(rows, F.col("installed"), F.lit("9.9")).select(
        "event_id", "appVersion", "sdkVersion", "customerVar")


_PAGE_URLS = """SELECT page_id, replace(replace(url, '?', '%3F'), '&', '%26') AS escaped, url FROM pages"""


@check("prj5_escape", _PAGE_URLS)
def escape(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    escaped = escape_params(pages.withColumn("escaped", F.col("url")), ["escaped"])
    return unescape_params(escaped.withColumn("url", F.col("escaped")), ["url"])


@check("prj9_legacy_order_items", f"""WITH {LINES_SQL},
parts AS (SELECT *,
  CASE WHEN ln < 5 AND pk % 5 <> 0 THEN '["sku:p' || pk || '","t' || pk || '","c' || (pk % 5) || '","' || CAST(amt - ship AS DECIMAL(18,2)) || '",' || qty || ']' END AS one,
  CASE WHEN ln < 5 AND qty > 25 THEN '["sku:g' || sk || '","gift","","1.00",1]' END AS two FROM lines)
SELECT CAST(ok * 10 + ln AS BIGINT) AS sn, {LINE_ORDER_ID} AS ec_id,
  CASE WHEN one IS NOT NULL OR two IS NOT NULL THEN '[' || concat_ws(',', one, two) || ']' END AS ec_items,
  CAST(amt AS VARCHAR) AS revenue, CAST(ship AS VARCHAR) AS ec_sh, CAST(CAST(amt - ship AS DECIMAL(18,2)) AS VARCHAR) AS ec_st
FROM parts""")
def legacy_order_items(spark, sf):
    rows = commerce.legacy_order_items(commerce.order_table(order_events(spark, sf)))
    return rows.select(F.col("sn").cast("bigint").alias("sn"), "ec_id", "ec_items", "revenue", "ec_sh", "ec_st")


@check("prj10_decode_legacy_items", """
WITH items AS (SELECT p_partkey, p_name, p_type, CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_size FROM part)
SELECT p_partkey, 0 AS line, CASE WHEN p_size % 4 > 0 THEN 's' || p_partkey END AS sku,
  CASE WHEN p_size % 4 > 0 THEN p_name END AS title, CASE WHEN p_size % 4 > 0 THEN p_type END AS category,
  CASE WHEN p_size % 4 > 0 THEN CAST(price AS DOUBLE) END AS price,
  CASE WHEN p_size % 4 > 0 THEN CAST(p_size AS BIGINT) END AS quantity,
  p_size % 4 = 0 AS ambiguous, CASE WHEN p_size % 4 = 0 THEN p_name END AS second FROM items""")
def decode_items(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    # every fourth item lacks its category, so later positions shift
    text = F.expr("""'[["sku:s' || p_partkey || '","' || p_name || '",'
      || CASE WHEN p_size % 4 > 0 THEN '"' || p_type || '",' ELSE '' END
      || '"' || CAST(p_retailprice AS DECIMAL(18,2)) || '",' || p_size || ']]'""")
    rows = commerce.decode_legacy_items(part.select("p_partkey", text.alias("ec_items")))
    return rows.select("p_partkey", "line", "sku", "title", "category",
                       F.col("price").cast("double").alias("price"), "quantity", "ambiguous",
                       F.when(F.col("ambiguous"), F.get("raw", F.lit(1))).alias("second"))


@check("prj14_build_page_url", """
SELECT page_id, 'http://app/' || url
  || CASE WHEN page_id % 3 > 0 THEN CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_campaign=c' || page_id ELSE '' END
  || CASE WHEN page_id % 3 > 0 AND page_id % 2 = 0 THEN '&pushContent=msg' ELSE '' END AS page_url FROM pages""")
def page_url(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    utm = F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("c"), F.col("page_id").cast("string")))
    push = F.when(F.col("page_id") % 2 == 0, "msg").otherwise("")
    url = projections.build_page_url(F.lit("app"), F.col("url"), utm, push)
    return pages.select("page_id", url.alias("page_url"))


@check("prj15_element_id", f"""WITH {TRACK_SQL}
SELECT event_id, substr(md5('pfxhttp://app/p' || k || CASE WHEN k % 2 = 0 THEN 'Win/Cell[' || k || ']' ELSE '(null)' END), 1, 16) AS id FROM track""")
def element_id(spark, sf):
    url = F.expr("'http://app/p' || k")
    path = F.expr("CASE WHEN k % 2 = 0 THEN 'Win/Cell[' || k || ']' END")
    return track(spark, sf, "event_id", "k", "deviceId").select(
        "event_id", clicks.element_id(url, path, prefix="pfx").alias("id"))


@check("prj16_session_id", f"""WITH {TRACK_SQL}
SELECT event_id, substr(md5('pfx-' || eventTime), 1, 16) AS sessionId FROM track""")
def session_id(spark, sf):
    rows = track(spark, sf, "event_id", "eventTime")
    return rows.select("event_id", sessions.session_id("eventTime", prefix="pfx-").alias("sessionId"))


@check("prj17_element_path", f"""WITH {TRACK_SQL}
SELECT event_id, 'Win/View[' || k || ']/UITableViewWrapperView/UIButton' AS ePath, 4 AS n_nodes,
  'View' AS second_cls, k AS second_idx, CAST(NULL AS INTEGER) AS last_idx FROM track WHERE eventName = 'click'""")
def element_path(spark, sf):
    rows = parse_click(track(spark, sf, "event_id", "eventName", "eventBody"), keep=("event_id",))
    rows = clicks.normalise_element_path(rows)
    return rows.select("event_id", "ePath", F.size("nodes").alias("n_nodes"),
                       F.col("nodes")[1]["cls"].alias("second_cls"), F.col("nodes")[1]["idx"].alias("second_idx"),
                       F.element_at("nodes", -1)["idx"].alias("last_idx"))


@check("prj18_element_position", f"""WITH {TRACK_SQL}
SELECT event_id, CASE WHEN k % 2 = 0 THEN k % 10 END AS section,
  CASE WHEN k % 2 = 0 THEN k % 7 WHEN k % 3 = 0 THEN k % 4 END AS row FROM track WHERE eventName = 'click'""")
def element_position(spark, sf):
    rows = parse_click(track(spark, sf, "event_id", "eventName", "eventBody"), keep=("event_id",))
    return clicks.split_element_position(rows).select("event_id", "section", "row")


@check("prj19_ud_variable", f"""WITH {TRACK_SQL}
SELECT event_id, CASE WHEN eventName IN ('error', 'bad name') THEN CAST(k AS VARCHAR) END AS level,
  CASE WHEN eventName = 'logout' OR (eventName = 'pageview' AND k % 2 = 0) THEN CAST(k AS VARCHAR) END AS ud_k FROM track""")
def ud_variable(spark, sf):
    rows = projections.merge_ud_variable(track(spark, sf, "event_id", "eventName", "eventBody"))
    return rows.select("event_id", F.col("ud")["level"].alias("level"), F.col("ud")["k"].alias("ud_k"))


@check("prj20_bridge_info", f"""WITH {TRACK_SQL}
SELECT event_id, CASE WHEN k % 3 = 0 THEN 'p2' ELSE 'p1' END AS sourceProjectId, 'p1' AS destProjectId,
  CASE WHEN k % 2 = 0 THEN 's9' END AS sourceSiteId, 's1' AS destSiteId, CASE WHEN k % 3 = 0 THEN 1 END AS dupFlag
FROM track WHERE k % 11 <> 0""")
def bridge_info(spark, sf):
    from footfall.operators.bodies import parse_h5

    host = bridge.bridge_fan_out(parse_h5(h5_messages(spark, sf)), "p1", "s1", forward=False)
    return bridge.bridge_info(host).select(
        "event_id", "sourceProjectId", "destProjectId", "sourceSiteId", "destSiteId", "dupFlag")


@check("prj21_order_subtotal", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(7.25 AS DECIMAL(18,2)) AS DOUBLE) AS ec_st FROM orders""")
def order_subtotal(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    st = commerce.order_subtotal(F.col("o_totalprice"), F.lit("7.25"))
    return orders.select("o_orderkey", st.cast("double").alias("ec_st"))


@check("prj22_action_path", """
SELECT p_partkey, 'screen/' || p_brand || '/' || p_type AS action_name,
  'http://app/screen/' || p_brand || '/' || p_type AS url, 'screen' AS level1, p_brand AS level2, p_type AS level3,
  CAST(NULL AS VARCHAR) AS level4, '["screen","' || p_brand || '","' || p_type || '"]' AS levels FROM part""")
def action_path(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    rows = part.select("p_partkey", F.array("p_brand", "p_type").alias("screens"))
    rows = projections.action_path(rows, F.lit("app"), prefix="screen", named=4)
    return rows.select("p_partkey", "action_name", "url", "level1", "level2", "level3", "level4", F.to_json("levels").alias("levels"))


@check("prj23_ua_header", f"""WITH {RAW_SQL}
SELECT event_id, CASE WHEN k % 13 > 0 THEN 'My App' END AS app_name, CASE WHEN k % 13 > 0 THEN appVersion END AS app_version,
  CASE WHEN k % 13 > 0 THEN 'iPhone 5 (GSM)' END AS platform, CASE WHEN k % 13 > 0 THEN osVersion END AS os_version FROM raw""")
def ua_header(spark, sf):
    header = F.expr("""CASE WHEN k % 13 > 0 THEN 'My App/' || appVersion || ' (iPhone 5 (GSM); iOS ' || osVersion || ')'
                       ELSE 'curl/8.0' END""")
    rows = raw(spark, sf).select("event_id", header.alias("user_agent"))
    return projections.parse_ua_header(rows).drop("user_agent")


@check("prj27_element_text", """
WITH kids AS (
  SELECT l_orderkey AS element_id, l_linenumber AS child_no,
    CASE l_linenumber % 4
      WHEN 0 THEN CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 't' || l_partkey END
      WHEN 1 THEN CASE WHEN l_partkey % 2 = 0 THEN 'unchecked' ELSE 'checked' END
      WHEN 2 THEN format('{:g}', l_quantity / 4)
      ELSE printf('%.6f', l_discount) END AS t
  FROM lineitem WHERE l_suppkey % 7 > 0)
SELECT element_id, string_agg(t, '-' ORDER BY child_no, t) AS eContent FROM kids WHERE t <> '' GROUP BY element_id""")
def element_text(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    kind = F.expr("CASE l_linenumber % 4 WHEN 0 THEN 'label' WHEN 1 THEN 'switch' WHEN 2 THEN 'stepper' ELSE 'slider' END")
    number = F.expr("""CASE l_linenumber % 4 WHEN 1 THEN CAST(l_partkey % 2 AS DOUBLE)
                       WHEN 2 THEN l_quantity / 4 ELSE l_discount END""")
    text = F.expr("CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 't' || l_partkey END")
    return clicks.element_text(lines.select(
        F.col("l_orderkey").alias("element_id"), F.col("l_linenumber").alias("child_no"),
        kind.alias("kind"), text.alias("text"), number.alias("number"),
        (F.col("l_suppkey") % 7 == 0).alias("hidden")))


@check("prj25_target_group", f"""WITH {TRACK_SQL}
SELECT event_id, CASE WHEN k % 5 = 4 THEN NULL ELSE 'g' || k END AS target_group_id FROM track""")
def target_group(spark, sf):
    """The key at four depths, inside objects and inside JSON held by text."""
    message = F.expr("""CASE k % 5
      WHEN 0 THEN '{"a":1,"target_group_id":"g' || k || '"}'
      WHEN 1 THEN '{"a":{"target_group_id":"g' || k || '"},"b":"{no"}'
      WHEN 2 THEN '{"x":"{\\\\"target_group_id\\\\":\\\\"g' || k || '\\\\"}","b":{"c":{"target_group_id":"deeper"}}}'
      WHEN 3 THEN '{"a":{"b":{"c":{"target_group_id":"g' || k || '"}}}}'
      ELSE '{"target":"none","list":["target_group_id"]}' END""")
    rows = track(spark, sf, "event_id", "k", "deviceId").select("event_id", message.alias("message"))
    return legacy.find_target_group(rows, "message").drop("message")
