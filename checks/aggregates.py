"""Aggregations, sorts and limits."""

from pyspark.sql import functions as F

from checks import check
from checks.fixtures import DEVICE_SQL, TRACK_SQL, track
from checks.legacy import LEGACY_SQL, mapped
from checks.windows import V1_SQL, W, _LANDED, _STATE, _VISITS_SQL, landed, sessions_sql
from footfall.operators import delivery, legacy, sessions
from footfall.operators.timeline import Timeline

_KEYED = ("event_id", "projectId", "siteId", "deviceId", "eventTime", "sn")


@check("agg1_queue_depth", f"""WITH {TRACK_SQL}
SELECT siteId, deviceId, count(*) AS depth, count(*) >= 60 AS "full" FROM track GROUP BY siteId, deviceId""")
def queue_depth(spark, sf):
    rows = delivery.queue_depth(track(spark, sf, "projectId", "siteId", "deviceId"), limit=60)
    return rows.drop("projectId")


SESSION_TABLE_SQL = f"""
SELECT projectId, siteId, deviceId, substr(md5(CAST(seStartTime AS VARCHAR)), 1, 16) AS sessionId, seStartTime,
  min(eventTime) AS first_event, max(eventTime) AS last_event, count(*) AS n_events
FROM sess GROUP BY projectId, siteId, deviceId, seStartTime"""


@check("agg3_session_table", f"WITH {TRACK_SQL}, {sessions_sql()} {SESSION_TABLE_SQL}")
def session_table(spark, sf):
    return sessions.sessions_per_device(track(spark, sf, *_STATE))


@check("agg4_visitor_table", f"""WITH {TRACK_SQL}, {_LANDED}, {V1_SQL}, {_VISITS_SQL}
SELECT siteId, deviceId, min(first_start) // 1000 AS first_visit, max(earlier) // 1000 AS previous_visit,
  max(n) AS visits FROM visits GROUP BY siteId, deviceId""")
def visitor_table(spark, sf):
    rows = sessions.visit_counters(sessions.sessionize_v1(Timeline(landed(spark, sf)))).frame()
    return sessions.visitor_table(rows).drop("projectId", "n_events")


@check("agg5_collect_vars", """
SELECT l_orderkey AS event_id, count(DISTINCT l_linenumber) AS n_vars, max(l_linenumber) AS top_idx,
  arg_max('v' || l_partkey || '-' || l_suppkey, l_linenumber * 100000000000 + pos) AS top_value
FROM (SELECT *, CAST(l_extendedprice * 100 AS BIGINT) * 100 + CAST(l_quantity AS BIGINT) AS pos FROM lineitem) GROUP BY l_orderkey""")
def collect_vars(spark, sf):
    settings = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_linenumber").alias("idx"),
        F.lit("n").alias("name"),
        F.expr("'v' || l_partkey || '-' || l_suppkey").alias("value"),
        F.expr("CAST(round(l_extendedprice * 100) AS BIGINT) * 100 + CAST(l_quantity AS BIGINT)").alias("position"),
    )
    rows = legacy.collect_vars(settings)
    indexes = F.transform(F.map_keys("vars"), lambda k: k.cast("int"))
    top = F.array_max(indexes)
    return rows.select(
        "event_id", F.size("vars").cast("bigint").alias("n_vars"), top.alias("top_idx"),
        F.element_at("vars", top.cast("string"))[1].alias("top_value"))


@check("srt1_order_v2", f"""WITH {TRACK_SQL} SELECT event_id, eventTime, CAST(sn AS BIGINT) AS sn FROM track ORDER BY eventTime, sn""")
def order_v2(spark, sf):
    rows = delivery.order_v2(track(spark, sf, "event_id", "eventTime", "sn"))
    return rows.select("event_id", "eventTime", F.col("sn").cast("bigint").alias("sn"))


@check("srt2_order_v1", f"""WITH {TRACK_SQL}, {LEGACY_SQL}
SELECT event_id, strftime(make_timestamp(eventTime // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS cdt,
  CASE WHEN search IS NULL THEN CAST(sn AS BIGINT) END AS lifetime_seq FROM legacy ORDER BY cdt, lifetime_seq NULLS LAST""")
def order_v1(spark, sf):
    rows = legacy.legacy_request_time(legacy.request_vars(mapped(spark, sf)))
    return delivery.order_v1(rows.select("event_id", "cdt", "cvar")).select(
        "event_id", "cdt", F.col("lifetime_seq").cast("bigint").alias("lifetime_seq"))


@check("srt3_take_oldest", f"""WITH {TRACK_SQL},
num AS (SELECT *, row_number() OVER {W} AS rn, count(*) OVER (PARTITION BY {DEVICE_SQL}) AS c FROM track)
SELECT event_id, CAST(rn AS INTEGER) AS queue_position, c > 10 AS has_more FROM num WHERE rn <= 10""")
def take_oldest(spark, sf):
    rows = delivery.take_oldest(track(spark, sf, *_KEYED), 10)
    return rows.select("event_id", "queue_position", "has_more")


@check("srt4_cap_per_device", f"""WITH {TRACK_SQL},
num AS (SELECT *, row_number() OVER (PARTITION BY {DEVICE_SQL}, eventTime // 86400000 ORDER BY eventTime, sn) AS rn FROM track)
SELECT event_id FROM num WHERE rn <= 2""")
def cap_per_device(spark, sf):
    rows = track(spark, sf, *_KEYED).withColumn("day", F.floor(F.col("eventTime") / 86400000))
    return delivery.cap_per_device(rows, limit=2, flush=("day",)).select("event_id")
