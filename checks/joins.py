"""Lookup joins."""

from checks import check
from checks.fixtures import RAW_SQL, TRACK_SQL, raw, track
from footfall.operators import clicks, dims, filters
from footfall.operators.bodies import parse_click
from pyspark.sql import functions as F


def _values(listing):
    return ", ".join(f"('{a}', '{b}')" for a, b in dims.pairs(listing))


@check("jon1_device_model", f"""WITH {RAW_SQL}, dim(code, name) AS (VALUES {_values(dims.DEVICE_MODELS)})
SELECT event_id, deviceCode, coalesce(name, deviceCode) AS uaDevice FROM raw LEFT JOIN dim ON deviceCode = code""")
def device_model(spark, sf):
    return dims.with_device_model(raw(spark, sf).select("event_id", "deviceCode"))


@check("jon2_network_type", f"""WITH {RAW_SQL}, dim(code, label) AS (VALUES {_values(dims.RADIO_LABELS)})
SELECT event_id, CASE reachability WHEN 'none' THEN 'no network' WHEN 'wifi' THEN 'Wifi' ELSE coalesce(label, '') END AS netType
FROM raw LEFT JOIN dim ON radio = code""")
def network_type(spark, sf):
    rows = dims.with_network_type(raw(spark, sf).select("event_id", "reachability", "radio"))
    return rows.select("event_id", "netType")


@check("jon6_override_properties", f"""WITH {TRACK_SQL}
SELECT event_id, CASE WHEN k % 4 = 0 THEN 'named ' || k ELSE 'c' || k END AS eContent,
  CASE WHEN k % 3 = 0 THEN 'UITableView' ELSE 'UIButton' END AS eType FROM track WHERE eventName = 'click'""")
def override_properties(spark, sf):
    rows = parse_click(track(spark, sf, "event_id", "eventName", "eventBody"), keep=("event_id",))
    rows = rows.withColumn("id", clicks.element_id(F.lit(""), "ePath"))
    listed = spark.range(0, 100, 4).select(
        F.expr("'Win/UITableViewWrapperView/View[' || id || ']/UITableViewWrapperView/UIButton'").alias("ePath"),
        F.expr("'named ' || id").alias("eContent"))
    listed = listed.select(clicks.element_id(F.lit(""), "ePath").alias("id"), "eContent")
    return clicks.override_properties(rows, listed).select("event_id", "eContent", "eType")


@check("jon5_allowed_events", f"""WITH {TRACK_SQL}
SELECT event_id FROM track WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  AND eventName NOT IN (SELECT 'click' FROM part UNION SELECT 'error' FROM part)""")
def allowed_events(spark, sf):
    """Opt-out and denylist tables as anti joins."""
    gone = spark.read.parquet(f"{sf}/customer.parquet").where("c_acctbal < 0")
    gone = gone.select(F.expr("substr(md5(CAST(c_custkey AS STRING)), 1, 16)").alias("deviceId"))
    part = spark.read.parquet(f"{sf}/part.parquet")
    names = part.select(F.expr("CASE WHEN p_partkey % 2 = 0 THEN 'click' ELSE 'error' END").alias("name"))
    rows = filters.not_opted_out(track(spark, sf, "event_id", "deviceId", "eventName"), gone, keys=("deviceId",))
    return filters.control_denylist(rows, names, e_type="eventName").select("event_id")
