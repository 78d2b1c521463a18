"""Streams, replayed over the given tables."""

from pyspark.sql import functions as F

from checks import check
from checks.aggregates import SESSION_TABLE_SQL
from checks.fixtures import DEVICE_SQL, TRACK_SQL, as_track, track
from checks.windows import AHEAD, BEFORE, CAMPAIGN_SQL, UP, W, _STATE, sessions_sql
from footfall.scratch import new_dir
from footfall.sources.events import stream_events
from footfall.sources.sinks import debug_sink as debug_sink_, read_events
from footfall.streaming import context, flush, sessions, triggers


def stream(spark, sf, *columns):
    """The events table as a stream of files."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxBytesPerTrigger", 1 << 30)
        .parquet(sf)
    )
    return as_track(files, *columns)


@check("str1_trigger", f"""WITH {TRACK_SQL} SELECT event_id, eventName FROM track""")
def trigger(spark, sf):
    return triggers.run_available(stream(spark, sf, "event_id", "eventName"), new_dir(spark, "copy")).select(
        "event_id", "eventName")


@check("str2_stream_sessions", f"""WITH {TRACK_SQL}, {sessions_sql(triggers=False)}
SELECT siteId, deviceId, seStartTime, max(eventTime) AS last_event, count(*) AS n_events
FROM sess GROUP BY {DEVICE_SQL}, seStartTime""")
def stream_sessions(spark, sf):
    path = new_dir(spark, "sessions")
    sessions.stream_stitched_sessions(stream(spark, sf, *_STATE), path, new_dir(spark, "stream"), interval_s=-1).awaitTermination()
    return sessions.read_sessions(spark, path).select("siteId", "deviceId", "seStartTime", "last_event", "n_events")


@check("str3_stream_sessions_with_triggers", f"WITH {TRACK_SQL}, {sessions_sql()} {SESSION_TABLE_SQL}".replace(
    "min(eventTime) AS first_event, ", ""))
def stream_sessions_with_triggers(spark, sf):
    """Three epochs that deal the events by a hash, so that most of them come late."""
    path = new_dir(spark, "sessions")
    body = sessions.continue_sessions(path)
    rows = track(spark, sf, *_STATE)
    for epoch in range(3):
        body(rows.where(F.pmod(F.xxhash64("sn"), F.lit(3)) == epoch), epoch)
    return sessions.read_sessions(spark, path)


@check("str4_stream_dedupe", f"""WITH {TRACK_SQL} SELECT siteId, deviceId, CAST(sn AS BIGINT) AS sn, eventName,
  CASE WHEN k % 3 = 0 THEN 'late' ELSE userId END AS userId, CAST(CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS version
FROM track""")
def stream_dedupe(spark, sf):
    """Two epochs: all events, then a third of them again, now with a user."""
    source, path = new_dir(spark, "copies"), new_dir(spark, "best")
    rows = track(spark, sf, "k", *_STATE, "url", "title", "userId")
    again = rows.where("k % 3 = 0")
    first = rows.withColumn("userId", F.when(F.col("k") % 3 != 0, F.col("userId")))
    for part in (first, again.withColumn("userId", F.lit("late"))):
        part.drop("k").coalesce(1).write.mode("append").parquet(source)
    files = stream_events(spark, source, files_per_trigger=1)
    flush.stream_best_copies(files, path, new_dir(spark, "stream"), -1).awaitTermination()
    return read_events(spark, path).select("siteId", "deviceId", F.col("sn").cast("bigint").alias("sn"), "eventName", "userId", "version")


@check("str5_stream_context", f"""WITH {TRACK_SQL}, {CAMPAIGN_SQL},
stated AS (SELECT *, CASE WHEN eventName = 'logout' THEN '-' ELSE userId END AS st,
  last_value(url IGNORE NULLS) OVER {BEFORE} AS came FROM tagged),
ctx AS (SELECT *, last_value(url IGNORE NULLS) OVER {UP} AS u, last_value(title IGNORE NULLS) OVER {UP} AS t,
  max(CASE WHEN url IS NOT NULL THEN sn END) OVER {UP} AS view_sn,
  coalesce(userId, nullif(last_value(st IGNORE NULLS) OVER {BEFORE}, '-')) AS user,
  CASE WHEN eventName IN ('login', 'register') THEN last_value(CASE WHEN eventName = 'initJPush' THEN 'r' || k END IGNORE NULLS) OVER {UP} END AS token
  FROM stated),
ref AS (SELECT projectId AS pp, siteId AS ps, deviceId AS pd, sn AS psn, came AS referrer FROM stated WHERE url IS NOT NULL)
SELECT siteId, deviceId, CAST(sn AS BIGINT) AS sn, u AS url, t AS title, referrer, utm, pushContent, user AS userId,
  token AS registrationID FROM ctx LEFT JOIN ref ON projectId = pp AND siteId = ps AND deviceId = pd AND view_sn = psn""")
def stream_context(spark, sf):
    path = new_dir(spark, "context")
    context.stream_context(stream(spark, sf), path, new_dir(spark, "stream"), interval_s=-1).awaitTermination()
    rows = context.read_context(spark, path)
    return rows.select("siteId", "deviceId", F.col("sn").cast("bigint").alias("sn"), "url", "title", "referrer",
                       "utm", "pushContent", "userId", "registrationID")


@check("str6_stream_flush", f"""WITH {TRACK_SQL},
num AS (SELECT *, (row_number() OVER {W} - 1) // 10 AS batch FROM track)
SELECT siteId, deviceId, batch, count(*) AS n_events FROM num GROUP BY siteId, deviceId, batch""")
def stream_flush(spark, sf):
    requests = new_dir(spark, "requests")
    query = flush.stream_flush(
        stream(spark, sf), new_dir(spark, "flushed"), requests, new_dir(spark, "flush"), interval_s=-1)
    query.awaitTermination()
    return spark.read.parquet(requests).select("siteId", "deviceId", "batch", "n_events")


@check("str7_late_user_attach", f"""WITH {TRACK_SQL},
ahead AS (SELECT *, first_value(userId IGNORE NULLS) OVER {AHEAD} AS u,
  first_value(CASE WHEN userId IS NOT NULL THEN eventTime END IGNORE NULLS) OVER {AHEAD} AS t FROM track)
SELECT event_id, u AS userId FROM ahead
WHERE userId IS NULL AND t - eventTime <= 36000000 AND eventTime >= 1704499200000 AND eventTime < 1706140800000""")
def late_user_attach(spark, sf):
    rows = track(spark, sf, "event_id", *_STATE, "userId")
    return flush.late_user_attach(rows, 1704499200000, 1706140800000, 36_000).select("event_id", "userId")


@check("snk4_debug_sink", "SELECT count(*) AS rows_read FROM events")
def debug_sink(spark, sf):
    """The sink that only reads: how many rows went by."""
    rows = stream(spark, sf, "event_id", "eventName")
    query = debug_sink_(rows, "noop", **triggers.trigger_from_interval(-1))
    query.awaitTermination()
    read = sum(p["numInputRows"] for p in query.recentProgress)
    return spark.createDataFrame([(read,)], "rows_read BIGINT")
