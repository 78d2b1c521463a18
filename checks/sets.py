"""Set operations."""

from pyspark.sql import functions as F

from checks import check
from checks.bodies import h5_messages
from checks.fixtures import TRACK_SQL, track
from checks.legacy import mapped
from checks.windows import _STATE
from footfall.operators import bridge, delivery
from footfall.operators.bodies import parse_h5
from footfall.operators.legacy import legacy_request_time
from footfall.functions.clock import utc_text

_HOST = """SELECT event_id, 'p1' AS projectId, 's1' AS siteId, CASE WHEN k % 3 = 0 THEN 1 END AS dupFlag,
  CASE WHEN k % 3 = 0 THEN 'p2' ELSE 'p1' END AS sourceProjectId FROM track WHERE k % 11 <> 0"""
_OWN = """SELECT event_id, 'p2', CASE WHEN k % 2 = 0 THEN 's9' ELSE 's1' END, 0, 'p2' FROM track WHERE k % 11 <> 0 AND k % 3 = 0"""


def _fanned(spark, sf):
    return bridge.bridge_fan_out(parse_h5(h5_messages(spark, sf)), "p1", "s1")


@check("set1_bridge_fan_out", f"WITH {TRACK_SQL} {_HOST} UNION ALL {_OWN}")
def bridge_fan_out(spark, sf):
    rows = bridge.bridge_info(_fanned(spark, sf))
    return rows.select("event_id", "projectId", "siteId", "dupFlag", "sourceProjectId")


@check("set2_drop_bridge_duplicates", f"""WITH {TRACK_SQL}
SELECT event_id, CASE WHEN k % 3 = 0 THEN 'p2' ELSE 'p1' END AS projectId FROM track WHERE k % 11 <> 0""")
def drop_bridge_duplicates(spark, sf):
    return bridge.drop_bridge_duplicates(_fanned(spark, sf)).select("event_id", "projectId")


@check("set3_unify_protocols", f"""WITH {TRACK_SQL}
SELECT 'v2' AS protocol, eventName AS name, count(*) AS n FROM track GROUP BY eventName
UNION ALL SELECT 'v1', CASE WHEN eventName = 'search' THEN 'search' ELSE eventName END, count(*) FROM track
WHERE eventName NOT IN ('initJPush', 'jPush', 'openChannel') GROUP BY eventName""")
def unify_protocols(spark, sf):
    v2 = track(spark, sf, *_STATE, "url", "title", "userId")
    v1 = mapped(spark, sf).select("siteId", "deviceId", "e_a", "search", "url", "title")
    name = F.coalesce("eventName", "e_a", F.when(F.col("search").isNotNull(), "search"))
    rows = bridge.unify_protocols(v1, v2)
    return rows.groupBy("protocol", name.alias("name")).agg(F.count("*").alias("n"))


_SECOND = "strftime(make_timestamp(eventTime // 1000 * 1000000), '%Y-%m-%d %H:%M:%S')"


@check("set3_unpaired_protocols", f"""WITH {TRACK_SQL},
v1 AS (SELECT deviceId, {_SECOND} AS cdt, eventName AS name FROM track
  WHERE eventName NOT IN ('initJPush', 'jPush', 'openChannel') AND k % 7 <> 0),
v2 AS (SELECT deviceId, {_SECOND} AS cdt, eventName AS name FROM track WHERE k % 5 <> 0
  UNION ALL SELECT deviceId, {_SECOND}, eventName FROM track WHERE k % 5 = 1)
SELECT 'v1' AS protocol, * FROM (FROM v1 EXCEPT ALL FROM v2) UNION ALL SELECT 'v2', * FROM (FROM v2 EXCEPT ALL FROM v1)""")
def unpaired_protocols(spark, sf):
    """A seventh of the one side and a fifth of the other are lost, some of the other are doubled."""
    keys = ("deviceId", "cdt", "name")
    name = F.coalesce("e_a", F.when(F.col("search").isNotNull(), "search"))
    v1 = legacy_request_time(mapped(spark, sf).where("k % 7 <> 0")).select("deviceId", "cdt", name.alias("name"))
    v2 = track(spark, sf, "k", *_STATE).withColumn("cdt", utc_text("eventTime")).withColumn("name", F.col("eventName"))
    v2 = v2.where("k % 5 <> 0").unionByName(v2.where("k % 5 = 1")).select(*keys)
    return bridge.unpaired(v1, v2, keys).select("protocol", *keys)


@check("set4_dedupe_events", f"""WITH {TRACK_SQL} SELECT event_id, eventName,
  CASE WHEN k % 3 = 0 THEN 'late' ELSE userId END AS userId FROM track""")
def dedupe_events(spark, sf):
    rows = track(spark, sf, "event_id", "k", *_STATE, "url", "title", "userId")
    resent = rows.where("k % 3 = 0")
    # a user that was attached between two sends
    later = resent.withColumn("userId", F.lit("late"))
    plain = resent.withColumn("userId", F.lit(None).cast("string"))
    sent = rows.withColumn("userId", F.when(F.col("k") % 3 != 0, F.col("userId")))
    return delivery.dedupe_events(sent.unionByName(later).unionByName(plain)).select("event_id", "eventName", "userId")
