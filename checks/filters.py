"""Filters."""

from pyspark.sql import functions as F

from checks import check
from checks.bodies import h5_messages
from checks.fixtures import LINE_ORDER_ID, LINES_SQL, RAW_SQL, TRACK_SQL, order_events, raw, track
from footfall.operators import commerce, filters, projections
from footfall.operators.bodies import parse_push
from footfall.schema import SCREEN_DENYLIST


def _ids(df):
    return df.select("event_id")


@check("flt1_valid_custom_name", f"""WITH {TRACK_SQL}
SELECT event_id, eventName FROM track WHERE regexp_full_match(eventName, '[a-zA-Z_0-9]+')""")
def valid_custom_name(spark, sf):
    rows = track(spark, sf, "event_id", "eventName")
    return filters.valid_custom_name(rows)


@check("flt2_valid_order", f"""WITH {LINES_SQL}
SELECT CAST(ok * 10 + ln AS BIGINT) AS sn, {LINE_ORDER_ID} AS orderID FROM lines WHERE ln <> 7""")
def valid_order(spark, sf):
    rows = filters.valid_order(commerce.order_table(order_events(spark, sf)))
    return rows.select(F.col("sn").cast("bigint").alias("sn"), "orderID")


@check("flt3_valid_push", f"""WITH {TRACK_SQL}
SELECT CAST(sn AS BIGINT) AS sn, 'a' || k AS alias FROM track WHERE eventName = 'jPush' AND k % 2 = 1""")
def valid_push(spark, sf):
    rows = parse_push(track(spark, sf, "projectId", "siteId", "deviceId", "eventName", "eventBody", "sn"))
    return filters.valid_push(rows).select(F.col("sn").cast("bigint").alias("sn"), "alias")


@check("flt4_valid_transaction", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
WHERE l_linenumber <> 7 AND l_partkey % 5 > 0 AND (l_quantity <= 25 OR l_suppkey % 3 > 0)""")
def valid_transaction(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    rows = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.expr("CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS STRING) END").alias("identifier"),
        F.expr("CASE WHEN l_partkey % 5 > 0 THEN l_extendedprice END").alias("grandTotal"),
        F.expr("""CASE WHEN l_quantity > 25
                  THEN array(named_struct('sku', 'a'), named_struct('sku', CASE WHEN l_suppkey % 3 > 0 THEN 'b' END))
                  ELSE array(named_struct('sku', 'a')) END""").alias("items"),
    )
    return filters.valid_transaction(rows).drop("identifier", "grandTotal", "items")


_SCREEN = f"""CASE k % 10 WHEN 0 THEN '{SCREEN_DENYLIST[0]}' WHEN 1 THEN '{SCREEN_DENYLIST[6]}'
  WHEN 2 THEN 'HiddenController' WHEN 3 THEN NULL ELSE 'Screen' || k END"""


def _screens(spark, sf):
    return track(spark, sf, "event_id", "k").selectExpr(
        "event_id", f"{_SCREEN} AS screen", "k % 4 = 0 AS has_web_view", "k")


@check("flt5_screen_denylist", f"""WITH {TRACK_SQL} SELECT event_id FROM track WHERE k % 10 > 2""")
def screen_denylist(spark, sf):
    return _ids(filters.screen_denylist(_screens(spark, sf), extra=["HiddenController"]))


@check("flt6_control_denylist", f"""WITH {RAW_SQL}
SELECT event_id, deviceCode FROM raw WHERE deviceCode NOT IN (SELECT 'iPad' || n || ',4' FROM range(1, 9) t(n))""")
def control_denylist(spark, sf):
    denied = spark.range(1, 9).select(F.expr("'iPad' || id || ',4'").alias("eType"))
    rows = raw(spark, sf).select("event_id", "deviceCode")
    return filters.control_denylist(rows, denied, e_type="deviceCode")


@check("flt7_legacy_eligible", f"""WITH {TRACK_SQL}
SELECT event_id, eventName FROM track WHERE eventName NOT IN ('initJPush', 'jPush', 'openChannel')""")
def legacy_eligible(spark, sf):
    return filters.legacy_eligible(track(spark, sf, "event_id", "eventName"))


@check("flt8_not_opted_out", """
SELECT event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IS NOT NULL)""")
def not_opted_out(spark, sf):
    gone = spark.read.parquet(f"{sf}/customer.parquet").where("c_acctbal < 0")
    gone = gone.select(F.expr("substr(md5(CAST(c_custkey AS STRING)), 1, 16)").alias("deviceId"))
    return _ids(filters.not_opted_out(track(spark, sf, "event_id", "deviceId"), gone, keys=("deviceId",)))


@check("flt9_sample", f"""WITH {TRACK_SQL}
SELECT event_id FROM track
WHERE ('0x' || substr(md5(deviceId || ':' || CAST(event_id + 1 AS VARCHAR)), 1, 8))::BIGINT % 101 <= 30""")
def sample(spark, sf):
    return _ids(filters.sample_events(track(spark, sf, "event_id", "deviceId", "sn"), rate=30))


@check("flt10_native_screens", f"""WITH {TRACK_SQL} SELECT event_id FROM track WHERE k % 10 > 1 AND k % 4 > 0""")
def native_screens(spark, sf):
    return _ids(filters.native_screens(_screens(spark, sf)))


@check("flt11_reject_malformed", f"""WITH {TRACK_SQL} SELECT event_id, k % 11 <> 0 AS good FROM track""")
def reject_malformed(spark, sf):
    good, bad = filters.reject_malformed(h5_messages(spark, sf))
    return good.select("event_id", F.lit(True).alias("good")).unionByName(
        bad.select("event_id", F.lit(False).alias("good")))


@check("flt12_net_known", f"""WITH {RAW_SQL} SELECT event_id, netType FROM raw WHERE netType NOT IN ('--', '')""")
def net_known(spark, sf):
    rows = raw(spark, sf).select("event_id", projections.known_net().alias("netType"))
    return rows.where("netType IS NOT NULL")
