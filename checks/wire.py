"""Sources and sinks."""

from pyspark.sql import functions as F

from checks import check
from checks.fixtures import DEVICE_SQL, TRACK_SQL, track
from checks.legacy import CVAR_SQL, LEGACY_SQL, mapped
from checks.windows import W
from footfall.operators import legacy
from footfall.operators.bridge import unify_protocols
from footfall.plans.rebuild import ingest, ingest_legacy
from footfall.scratch import new_dir
from footfall.sources import events as stored
from footfall.sources import sinks, wire

_FLAT = ("eventTime", "eventName", "eventBody", "url", "title", "userId", "userProperty")
_ROWS_SQL = f"""SELECT siteId, deviceId, CAST(sn AS VARCHAR) AS sn, {", ".join(_FLAT)} FROM track"""


def _rows(df):
    return df.select("siteId", "deviceId", F.col("sn").cast("string").alias("sn"), *_FLAT)


@check("src1_scan_events", f"""WITH {TRACK_SQL} {_ROWS_SQL}""")
def scan_events(spark, sf):
    path = new_dir(spark, "events")
    stored.with_event_date(track(spark, sf)).write.partitionBy("event_date").parquet(path)
    return _rows(stored.scan_events(spark, path))


@check("src2_decode_bulk_v2", f"""WITH {TRACK_SQL} {_ROWS_SQL}
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part""")
def decode_bulk_v2(spark, sf):
    """Requests made of the events, plus one unreadable body per part."""
    payloads = wire.encode_bulk(track(spark, sf)).select("body")
    part = spark.read.parquet(f"{sf}/part.parquet")
    bad = part.select(F.expr("CASE WHEN p_partkey % 2 = 0 THEN '%7Bno' || p_name ELSE '%zz' END").alias("body"))
    return _rows(wire.decode_bulk_v2(payloads.unionByName(bad)))


_V1 = ("idsite", "deviceId", "e_c", "e_a", "e_n", "search", "url", "title", "cvar", "new_visit", "ec_tx")


def _legacy(spark, sf):
    rows = legacy.request_vars(legacy.legacy_request_time(mapped(spark, sf)))
    return rows.withColumn("idsite", F.col("siteId"))


@check("src3_decode_bulk_v1", f"""WITH {TRACK_SQL}, {LEGACY_SQL}
SELECT siteId AS idsite, deviceId, e_c, e_a, e_n, search, url, title, {CVAR_SQL} AS cvar, new_visit, ec_tx FROM legacy""")
def decode_bulk_v1(spark, sf):
    payloads = wire.encode_bulk_v1(_legacy(spark, sf)).select("body")
    return wire.decode_bulk_v1(payloads).select(*_V1)


def _pair(name, expr=None, escape=False):
    value = expr or name
    if escape:
        value = f"replace(replace({value}, '?', '%3F'), '&', '%26')"
    return f"'{name}=' || {value}"


_QUERY = "'?' || concat_ws('&', " + ", ".join([
    _pair("projectId"), _pair("siteId"), _pair("deviceId"), _pair("userId"), _pair("eventTime"), _pair("sn"),
    _pair("eventName", escape=True), _pair("eventBody", escape=True), _pair("url", escape=True),
    _pair("title", escape=True), _pair("userProperty"),
]) + ")"


@check("snk1_encode_bulk", f"""WITH {TRACK_SQL},
num AS (SELECT *, (row_number() OVER {W} - 1) // 10 AS batch, {_QUERY} AS q FROM track)
SELECT siteId, deviceId, batch, count(*) AS n_events, CAST(json_object('requests', list(q ORDER BY eventTime, sn)) AS VARCHAR) AS body
FROM num GROUP BY {DEVICE_SQL}, batch""")
def encode_bulk(spark, sf):
    payloads = wire.encode_bulk(track(spark, sf))
    body = F.url_decode(F.replace("body", F.lit("+"), F.lit("%2B")))
    return payloads.select("siteId", "deviceId", "batch", "n_events", body.alias("body"))


@check("snk2_write_idempotent", f"""WITH {TRACK_SQL} SELECT siteId, deviceId, CAST(sn AS BIGINT) AS sn, eventTime, eventName, url,
  CASE WHEN k >= 40 THEN coalesce(userId, 'late') END AS userId, CAST(CASE WHEN k >= 40 THEN 1 ELSE 0 END AS BIGINT) AS version
FROM track""")
def write_idempotent(spark, sf):
    """Two overlapping epochs, the second one replayed; its copies know the user, those of the
    first do not."""
    path = new_dir(spark, "idempotent")
    rows = track(spark, sf, "k", "projectId", "siteId", "deviceId", "sn", *_FLAT)
    first = rows.where("k < 70").withColumn("userId", F.lit(None).cast("string"))
    sinks.write_idempotent(first.drop("k"), 0, path)
    for _ in range(2):
        second = rows.where("k >= 40").withColumn("userId", F.coalesce("userId", F.lit("late")))
        sinks.write_idempotent(second.drop("k"), 1, path)
    found = sinks.read_events(spark, path)
    return found.select("siteId", "deviceId", F.col("sn").cast("bigint").alias("sn"), "eventTime", "eventName", "url", "userId", "version")


@check("snk3_fan_out", f"""WITH {TRACK_SQL}
SELECT 'v2' AS protocol, siteId, count(*) AS n, count(DISTINCT deviceId) AS devices FROM track GROUP BY siteId
UNION ALL SELECT 'v1', siteId, count(*), count(DISTINCT deviceId) FROM track
WHERE eventName NOT IN ('initJPush', 'jPush', 'openChannel') GROUP BY siteId""")
def fan_out(spark, sf):
    current, old = new_dir(spark, "current"), new_dir(spark, "legacy")
    sinks.fan_out(track(spark, sf), current, old)
    columns = ("siteId", "deviceId")
    both = unify_protocols(
        spark.read.parquet(old).select(*columns), spark.read.parquet(current).select(*columns))
    return both.groupBy("protocol", "siteId").agg(
        F.count("*").alias("n"), F.countDistinct("deviceId").alias("devices"))


@check("agg2_batch_collect", f"""WITH {TRACK_SQL},
num AS (SELECT *, (row_number() OVER {W} - 1) // 20 AS batch FROM track)
SELECT siteId, deviceId, batch, count(*) AS n_events, CAST(min(sn) AS BIGINT) AS first_sn, CAST(max(sn) AS BIGINT) AS last_sn
FROM num GROUP BY {DEVICE_SQL}, batch""")
def batch_collect(spark, sf):
    """The arrays inside requests of 20, read back: their size and order."""
    payloads = wire.encode_bulk(track(spark, sf, "projectId", "siteId", "deviceId", "eventTime", "sn"), 20)
    body = F.url_decode(F.replace("body", F.lit("+"), F.lit("%2B")))
    requests = F.from_json(body, "requests ARRAY<STRING>")["requests"]

    def sn(item):
        return F.regexp_extract(item, "&sn=([0-9]+)", 1).cast("bigint")

    return payloads.select(
        "siteId", "deviceId", "batch", F.size(requests).cast("bigint").alias("n_events"),
        sn(F.get(requests, F.lit(0))).alias("first_sn"), sn(F.element_at(requests, -1)).alias("last_sn"))


@check("plan_ingest", f"""WITH {TRACK_SQL} {_ROWS_SQL}""")
def ingested(spark, sf):
    """All requests sent twice, some for a third time."""
    payloads = wire.encode_bulk(track(spark, sf)).select("body", "batch")
    again = payloads.unionByName(payloads).unionByName(payloads.where("batch % 3 = 0"))
    events, _ = ingest(again.select("body"))
    return _rows(events)


@check("plan_ingest_legacy", f"""WITH {TRACK_SQL}, {LEGACY_SQL}
SELECT siteId AS idsite, deviceId, e_c, e_a, e_n, search, url, title, {CVAR_SQL} AS cvar, new_visit, ec_tx FROM legacy""")
def ingested_legacy(spark, sf):
    """All legacy requests sent twice, beside bodies that cannot be read."""
    payloads = wire.encode_bulk_v1(_legacy(spark, sf)).select("body")
    part = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("{no "), "p_name").alias("body"))
    rows, _ = ingest_legacy(payloads.unionByName(payloads).unionByName(part))
    return rows.select(*_V1)


@check("plan_ingest_quarantine", """SELECT p_partkey, p_partkey % 3 = 0 AS untimed FROM part""")
def quarantine(spark, sf):
    """Bodies of both kinds that go to quarantine: unreadable ones, and events without a time."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    untimed = F.concat(F.lit('{"requests":["?idsite=s1&e_a=a&title='), F.col("p_partkey").cast("string"), F.lit('"]}'))
    body = F.when(F.col("p_partkey") % 3 == 0, untimed).otherwise(F.concat(F.lit("{no "), F.col("p_partkey").cast("string")))
    rows, bad = ingest_legacy(part.select(body.alias("body"), "p_partkey"))
    return bad.select("p_partkey", (~F.col("malformed")).alias("untimed"))
