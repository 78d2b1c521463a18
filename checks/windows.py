"""Device state: sessions, page context, campaigns, identity, counters."""

import uuid

from pyspark.sql import functions as F

from checks import check
from checks.fixtures import DEVICE_SQL, TRACK_SQL, track
from footfall.operators import context, delivery, identity, sessions
from footfall.operators.timeline import Timeline
from footfall.operators.identity import backfill_between
from footfall.plans.rebuild import continue_state, rebuild_state
from footfall.schema import DEVICE
from footfall.scratch import new_dir
from footfall.sources.epochs import EpochTable
from footfall.sources.stored import DeviceStore

W = f"(PARTITION BY {DEVICE_SQL} ORDER BY eventTime, sn)"
UP = f"(PARTITION BY {DEVICE_SQL} ORDER BY eventTime, sn ROWS UNBOUNDED PRECEDING)"
BEFORE = f"(PARTITION BY {DEVICE_SQL} ORDER BY eventTime, sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
AHEAD = f"(PARTITION BY {DEVICE_SQL} ORDER BY eventTime, sn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"

_STATE = ("projectId", "siteId", "deviceId", "eventTime", "sn", "eventName", "eventBody")


def sessions_sql(source: str = "track", triggers: bool = True, timeout_ms: int = 1_800_000) -> str:
    restart = """ OR eventName = 'openChannel' OR (eventName = 'jPush' AND k % 3 <> 0 AND k % 2 <> 0)"""
    return f"""
lagged AS (SELECT *, lag(eventTime) OVER {W} AS prev FROM {source}),
flagged AS (SELECT *, prev IS NULL OR eventTime - prev >= {timeout_ms}
  OR eventTime // 86400000 <> prev // 86400000{restart if triggers else ""} AS newSession FROM lagged),
sess AS (SELECT *, max(CASE WHEN newSession THEN eventTime END) OVER {UP} AS seStartTime FROM flagged)"""


@check("win1_sessionize_v2", f"""WITH {TRACK_SQL}, {sessions_sql()}
SELECT event_id, seStartTime, substr(md5('pfx' || seStartTime), 1, 16) AS sessionId, newSession FROM sess""")
def sessionize_v2(spark, sf):
    rows = sessions.sessionize_v2(track(spark, sf, "event_id", *_STATE), prefix="pfx")
    return rows.select("event_id", "seStartTime", "sessionId", "newSession")


V1_SQL = f"""
lagged AS (SELECT *, lag(eventTime) OVER {W} AS prev FROM landed),
flagged AS (SELECT *, prev IS NULL OR eventTime - prev >= 1800000
  OR (eventName = 'pageview' AND k % 20 = 0) AS new_visit FROM lagged),
sess AS (SELECT *, max(CASE WHEN new_visit THEN eventTime END) OVER {UP} AS seStartTime FROM flagged)"""
_LANDED = "landed AS (SELECT * FROM track)"


def landed(spark, sf):
    """Track events where every 20th page carries a campaign in its url."""
    rows = track(spark, sf, "event_id", "k", *_STATE, "url", "title")
    tagged = F.when(F.col("k") % 20 == 0, F.concat("url", F.lit("&utm_campaign=c")))
    return rows.withColumn("url", F.coalesce(tagged, "url"))


@check("win2_sessionize_v1", f"""WITH {TRACK_SQL}, {_LANDED}, {V1_SQL}
SELECT event_id, seStartTime, new_visit FROM sess""")
def sessionize_v1(spark, sf):
    return sessions.sessionize_v1(landed(spark, sf)).select("event_id", "seStartTime", "new_visit")


_PAGES = f"""
moves AS (SELECT *, last_value(url IGNORE NULLS) OVER {BEFORE} AS came FROM track),
ctx AS (SELECT *, last_value(url IGNORE NULLS) OVER {UP} AS u, last_value(title IGNORE NULLS) OVER {UP} AS t,
  max(CASE WHEN url IS NOT NULL THEN sn END) OVER {UP} AS view_sn FROM moves),
ref AS (SELECT projectId AS pp, siteId AS ps, deviceId AS pd, sn AS psn, came AS referrer FROM moves WHERE url IS NOT NULL)"""


@check("win3_page_context", f"""WITH {TRACK_SQL}, {_PAGES}
SELECT event_id, u AS url, t AS title, referrer FROM ctx
LEFT JOIN ref ON projectId = pp AND siteId = ps AND deviceId = pd AND view_sn = psn""")
def page_context(spark, sf):
    rows = context.page_context(track(spark, sf, "event_id", *_STATE, "url", "title"))
    return rows.select("event_id", "url", "title", "referrer")


@check("win4_legacy_page_url", f"""WITH {TRACK_SQL}
SELECT event_id, coalesce(last_value(url IGNORE NULLS) OVER {UP}, 'http://app') AS url FROM track""")
def legacy_page_url(spark, sf):
    rows = context.legacy_page_url(track(spark, sf, "event_id", *_STATE, "url"), F.lit("app"))
    return rows.select("event_id", "url")


CARRIED_SQL = f"""
stated AS (SELECT *, CASE WHEN eventName = 'logout' THEN '-' ELSE userId END AS st FROM track),
carried AS (SELECT *, coalesce(userId, nullif(last_value(st IGNORE NULLS) OVER {BEFORE}, '-')) AS carriedUser FROM stated)"""


@check("win5_backfill_user", f"""WITH {TRACK_SQL},
ahead AS (SELECT *, first_value(userId IGNORE NULLS) OVER {AHEAD} AS u,
  first_value(CASE WHEN userId IS NOT NULL THEN eventTime END IGNORE NULLS) OVER {AHEAD} AS t FROM track)
SELECT event_id, CASE WHEN t - eventTime <= 36000000 THEN u END AS userId FROM ahead""")
def backfill_user(spark, sf):
    rows = track(spark, sf, "event_id", *_STATE, "userId")
    return identity.backfill_user(rows, horizon_s=36_000).select("event_id", "userId")


@check("win6_carry_user", f"""WITH {TRACK_SQL}, {CARRIED_SQL} SELECT event_id, carriedUser AS userId FROM carried""")
def carry_user(spark, sf):
    return identity.carry_user(track(spark, sf, "event_id", *_STATE, "userId")).select("event_id", "userId")


@check("win7_carry_user_property", f"""WITH {TRACK_SQL},
stated AS (SELECT *, CASE WHEN eventName = 'logout' THEN '-' ELSE userProperty END AS st FROM track)
SELECT event_id, coalesce(userProperty, nullif(last_value(st IGNORE NULLS) OVER {BEFORE}, '-')) AS userProperty FROM stated""")
def carry_user_property(spark, sf):
    rows = track(spark, sf, "event_id", *_STATE, "userProperty")
    return identity.carry_user_property(rows).select("event_id", "userProperty")


@check("win8_carry_registration", f"""WITH {TRACK_SQL},
held AS (SELECT *, last_value(CASE WHEN eventName = 'initJPush' THEN 'r' || k END IGNORE NULLS) OVER {UP} AS token FROM track)
SELECT event_id, CASE WHEN eventName IN ('login', 'register') THEN token END AS registrationID FROM held""")
def carry_registration(spark, sf):
    rows = identity.carry_registration(track(spark, sf, "event_id", *_STATE))
    return rows.select("event_id", "registrationID")


# independent of the operator: positions come from grouping by earlier views
CAMPAIGN_SQL = f"""
pos AS (SELECT *, row_number() OVER {W} AS at FROM track),
grp AS (SELECT *, count(CASE WHEN eventName = 'pageview' THEN 1 END) OVER {BEFORE} AS views,
  CASE WHEN eventName = 'openChannel' THEN CASE WHEN k = 0 THEN '' ELSE 'ch' || k END
       WHEN eventName = 'jPush' THEN 'trackJPush' END AS setter FROM pos),
utm0 AS (SELECT *, CASE WHEN eventName = 'pageview' THEN nullif(last_value(setter IGNORE NULLS) OVER (
  PARTITION BY {DEVICE_SQL}, views ORDER BY eventTime, sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS utm FROM grp),
use0 AS (SELECT *, count(utm) OVER {BEFORE} AS uses FROM utm0),
camp AS (SELECT *, CASE WHEN utm IS NOT NULL THEN nullif(last_value(
  CASE WHEN eventName = 'jPush' THEN CASE WHEN k % 5 = 0 THEN '' ELSE 'msg ' || k END END IGNORE NULLS) OVER (
  PARTITION BY {DEVICE_SQL}, uses ORDER BY eventTime, sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS pushContent FROM use0),
tagged AS (SELECT * EXCLUDE (url), url || CASE WHEN utm IS NULL THEN '' ELSE
  CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_campaign=' || utm
  || coalesce('&pushContent=' || pushContent, '') END AS url FROM camp)"""


@check("win9_attribute_campaign", f"""WITH {TRACK_SQL}, {CAMPAIGN_SQL}
SELECT event_id, utm, pushContent, url FROM tagged WHERE eventName = 'pageview'""")
def attribute_campaign(spark, sf):
    rows = context.attribute_campaign(track(spark, sf, "event_id", *_STATE, "url"))
    return rows.where("eventName = 'pageview'").select("event_id", "utm", "pushContent", "url")


_VISITS_SQL = f"""
visits AS (SELECT *, row_number() OVER w AS n, coalesce(lag(seStartTime) OVER w, seStartTime) AS earlier,
    min(seStartTime) OVER (PARTITION BY {DEVICE_SQL}) AS first_start
  FROM sess WHERE new_visit WINDOW w AS (PARTITION BY {DEVICE_SQL} ORDER BY eventTime, sn)),
numbered AS (SELECT *, count(CASE WHEN new_visit THEN 1 END) OVER {UP} AS n FROM sess)"""


@check("win10_visit_counters", f"""WITH {TRACK_SQL}, {_LANDED}, {V1_SQL}, {_VISITS_SQL}
SELECT a.event_id, a.n AS _idvc, b.earlier // 1000 AS _viewts, b.first_start // 1000 AS _idts, a.new_visit
FROM numbered a JOIN visits b USING (projectId, siteId, deviceId, n)""")
def visit_counters(spark, sf):
    rows = sessions.visit_counters(sessions.sessionize_v1(Timeline(landed(spark, sf)))).frame()
    return rows.select("event_id", "_idvc", "_viewts", "_idts", "new_visit")


@check("win11_assign_sn", f"""WITH {TRACK_SQL}
, given AS (SELECT *, CASE WHEN k % 2 = 0 THEN CAST(sn AS BIGINT) END AS g,
  row_number() OVER (PARTITION BY {DEVICE_SQL} ORDER BY eventTime, event_id) AS n FROM track)
SELECT event_id, coalesce(g, coalesce(last_value(g IGNORE NULLS) OVER up, 0) + n
  - coalesce(last_value(CASE WHEN g IS NOT NULL THEN n END IGNORE NULLS) OVER up, 0)) AS sn
FROM given WINDOW up AS (PARTITION BY {DEVICE_SQL} ORDER BY eventTime, event_id ROWS UNBOUNDED PRECEDING)""")
def assign_sn(spark, sf):
    rows = track(spark, sf, "event_id", "k", "projectId", "siteId", "deviceId", "eventTime", "sn")
    rows = rows.withColumn("sn", F.when(F.col("k") % 2 == 0, F.col("sn")))
    rows = delivery.assign_sn(rows, order=("eventTime", "event_id"))
    return rows.select("event_id", F.col("sn").cast("bigint").alias("sn"))


@check("win12_batch_index", f"""WITH {TRACK_SQL}
SELECT event_id, (row_number() OVER {W} - 1) // 10 AS batch FROM track""")
def batch_index(spark, sf):
    rows = track(spark, sf, "event_id", "projectId", "siteId", "deviceId", "eventTime", "sn")
    return delivery.batch_index(rows).select("event_id", "batch")


@check("win13_visit_vars", f"""WITH {TRACK_SQL}, {sessions_sql()}
SELECT event_id, last_value(CASE WHEN k % 4 = 0 THEN 'v' || k WHEN newSession THEN 'fresh' END IGNORE NULLS) OVER (
  PARTITION BY {DEVICE_SQL}, seStartTime ORDER BY eventTime, sn ROWS UNBOUNDED PRECEDING) AS v FROM sess""")
def visit_vars(spark, sf):
    def variables(v):
        return F.create_map(F.lit("a"), v)

    rows = track(spark, sf, "event_id", "k", *_STATE)
    own = F.when(F.col("k") % 4 == 0, variables(F.concat(F.lit("v"), F.col("k").cast("string"))))
    line = sessions.sessionize_v2(Timeline(rows.withColumn("visitVars", own)))
    rows = sessions.visit_vars_scope(line, at_start=variables(F.lit("fresh"))).frame()
    return rows.select("event_id", F.col("visitVars")["a"].alias("v"))


@check("jon3_campaign_views", f"""WITH {TRACK_SQL}, {CAMPAIGN_SQL}
SELECT utm, count(*) AS views, count(pushContent) AS with_push FROM tagged WHERE utm IS NOT NULL GROUP BY utm""")
def campaign_views(spark, sf):
    rows = context.attribute_campaign(track(spark, sf, *_STATE, "url")).where("utm IS NOT NULL")
    return rows.groupBy("utm").agg(F.count("*").alias("views"), F.count("pushContent").alias("with_push"))


RESOLVED_SQL = f"""
known AS (SELECT * EXCLUDE (userId), carriedUser AS userId FROM carried),
ahead AS (SELECT *, first_value(userId IGNORE NULLS) OVER {AHEAD} AS u,
  first_value(CASE WHEN userId IS NOT NULL THEN eventTime END IGNORE NULLS) OVER {AHEAD} AS t FROM known),
resolved AS (SELECT * EXCLUDE (userId), coalesce(userId, CASE WHEN t - eventTime <= 3600000 THEN u END) AS userId FROM ahead)"""


@check("jon4_resolve_user", f"""WITH {TRACK_SQL}, {CARRIED_SQL}, {RESOLVED_SQL} SELECT event_id, userId FROM resolved""")
def resolve_user(spark, sf):
    rows = identity.resolve_user(track(spark, sf, "event_id", *_STATE, "userId"), horizon_s=3600)
    return rows.select("event_id", "userId")


REBUILD_SQL = f"""WITH {TRACK_SQL}, {CARRIED_SQL}, {RESOLVED_SQL}, {sessions_sql("resolved")}, {CAMPAIGN_SQL.replace("FROM track", "FROM sess")},
moves AS (SELECT *, last_value(url IGNORE NULLS) OVER {BEFORE} AS came FROM tagged),
ctx AS (SELECT *, last_value(url IGNORE NULLS) OVER {UP} AS page_url, last_value(title IGNORE NULLS) OVER {UP} AS page_title,
  max(CASE WHEN url IS NOT NULL THEN sn END) OVER {UP} AS view_sn FROM moves),
ref AS (SELECT projectId AS pp, siteId AS ps, deviceId AS pd, sn AS psn, came AS referrer FROM moves WHERE url IS NOT NULL)
SELECT event_id, seStartTime, page_url AS url, page_title AS title, referrer, utm, pushContent, userId FROM ctx
LEFT JOIN ref ON projectId = pp AND siteId = ps AND deviceId = pd AND view_sn = psn"""
_REBUILT = ("event_id", "seStartTime", "url", "title", "referrer", "utm", "pushContent", "userId")


@check("plan_rebuild_state", REBUILD_SQL)
def rebuild(spark, sf):
    rows = track(spark, sf, "event_id", *_STATE, "url", "title", "userId", "userProperty")
    return rebuild_state(rows, horizon_s=3600).select(*_REBUILT)


@check("plan_daily_state", REBUILD_SQL)
def daily_state(spark, sf):
    """Four runs, each going on from the state and the waiting rows of the one before."""
    rows = track(spark, sf, "event_id", *_STATE, "url", "title", "userId", "userProperty")
    cuts = [0, 1704300000000, 1704700000000, 1705800000000, 10**14]
    states, held, out = EpochTable(spark, new_dir(spark, "states"), DEVICE), None, None
    for run, (first, end) in enumerate(zip(cuts, cuts[1:])):
        part = rows.where((F.col("eventTime") >= first) & (F.col("eventTime") < end))
        done, state = continue_state(part, states.read(before=run))
        states.write(state, run)
        settled, held = backfill_between(done.drop("late"), held, 3600)
        out = settled if out is None else out.unionByName(settled)
    return out.unionByName(held).select(*_REBUILT)


@check("src1_device_store", REBUILD_SQL)
def device_store(spark, sf):
    """State over a table that is stored by device, in two batches of days."""
    rows = track(spark, sf, "event_id", *_STATE, "url", "title", "userId", "userProperty")
    store = DeviceStore(spark, f"stored_{uuid.uuid4().hex}", new_dir(spark, "stored"), 8)
    cut = 1705000000000
    for batch, part in enumerate((rows.where(F.col("eventTime") < cut), rows.where(F.col("eventTime") >= cut))):
        store.append(part, batch, busy=5)
    return rebuild_state(store.scan(), horizon_s=3600, hot=store.hot()).select(*_REBUILT)
