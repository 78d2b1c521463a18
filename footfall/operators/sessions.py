"""Sessions, visits and their tables."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import hash16
from footfall.functions.clock import day_number
from footfall.operators.timeline import on_timeline
from footfall.schema import (
    DEVICE, OPEN_CHANNEL, PAGEVIEW, PUSH, SESSION_TIMEOUT_S,
)


def session_id(start_ms="seStartTime", prefix: str = "") -> Column:
    """Session id from its start. Give the client's own prefix to get the ids
    the client writes; any prefix gives ids that are unique per device and start."""
    start = F.col(start_ms) if isinstance(start_ms, str) else start_ms
    return hash16(F.lit(prefix), start.cast("string"))


def restarts_session() -> Column:
    """Events that open a session themselves: a channel opening, or a push with
    both campaign ids. They are the first event of the new session."""
    name, body = F.col("eventName"), F.col("eventBody")

    def number(path):  # only pushes pay for JSON
        return F.coalesce(F.get_json_object(body, path).try_cast("int"), F.lit(0))

    push = (name == PUSH) & (number("$.dcid") != 0) & (number("$.dtg") != 0)
    return F.coalesce((name == OPEN_CHANNEL) | push, F.lit(False))


@on_timeline
def sessionize_v2(events, timeout_s: int = SESSION_TIMEOUT_S, tz="UTC", prefix: str = "", triggers=True):
    """`sessionId`, `seStartTime`, `newSession`. A session ends after `timeout_s`
    of silence (a gap of exactly that long ends it), at midnight in `tz`, and
    before an event that restarts it."""
    now, then = F.col("eventTime"), F.col("__then")
    new = (
        then.isNull()
        | (now - then >= timeout_s * 1000)
        | (day_number(now, tz) != day_number(then, tz))
    )
    if triggers:
        new = new | restarts_session()
    return (
        events.before(__then=now)
        .set(newSession=F.coalesce(new, F.lit(False)))
        .last(seStartTime=F.when(F.col("newSession"), now))
        .set(sessionId=session_id(prefix=prefix))
        .drop("__then")
    )


def _landing_page() -> Column:
    lands = (F.col("eventName") == PAGEVIEW) & F.col("url").contains("utm_campaign")
    return F.coalesce(lands, F.lit(False))


@on_timeline
def sessionize_v1(events, timeout_s: int = SESSION_TIMEOUT_S):
    """`new_visit` and `seStartTime` of the legacy rule: silence only, plus page
    views whose url carries a campaign."""
    now, then = F.col("eventTime"), F.col("__then")
    new = then.isNull() | (now - then >= timeout_s * 1000) | _landing_page()
    return (
        events.before(__then=now)
        .set(new_visit=F.coalesce(new, F.lit(False)))
        .last(seStartTime=F.when(F.col("new_visit"), now))
        .drop("__then")
    )


@on_timeline
def visit_counters(events, flag: str = "new_visit", start: str = "seStartTime"):
    """`_idvc` visits so far, `_viewts` start of the visit before this one (of
    the first visit: its own), `_idts` first visit; times in whole seconds."""
    opens = F.col(flag)
    return (
        events.fill(
            total={"_idvc": opens.cast("bigint")},
            before={"__earlier": F.when(opens, F.col(start))},
            lowest={"__first": F.col(start)},
        )
        .set(__earlier=F.when(opens, F.struct(F.coalesce("__earlier", F.col(start)).alias("at"))))
        .last(__earlier=F.col("__earlier"))
        .set(
            _viewts=F.floor(F.col("__earlier.at") / 1000),
            _idts=F.floor(F.col("__first") / 1000),
        )
        .drop("__earlier", "__first")
    )


@on_timeline
def visit_vars_scope(
    events, variables: str = "visitVars", start: str = "seStartTime", flag: str = "newSession",
    at_start: Column | None = None,
):
    """Visit variables hold until the session ends; screen variables stay with
    their own row and need no operator. `at_start` is what every new session
    begins with where its first event sets nothing itself."""
    own = F.col(variables)
    if at_start is not None:
        own = F.coalesce(own, F.when(F.col(flag), at_start))
    held = F.when(own.isNotNull(), F.struct(F.col(start).alias("at"), own.alias("vars")))
    same = F.col("__held.at").eqNullSafe(F.col(start))
    return (
        events.last(__held=held)
        .set(**{variables: F.when(same, F.col("__held.vars"))})
        .drop("__held")
    )


def session_table(events: DataFrame, start: str = "seStartTime") -> DataFrame:
    """One row per session, combined before the shuffle."""
    return events.groupBy(*DEVICE, "sessionId", start).agg(
        F.min("eventTime").alias("first_event"),
        F.max("eventTime").alias("last_event"),
        F.count("*").alias("n_events"),
    )


def visitor_table(events: DataFrame) -> DataFrame:
    """One row per device from events with `visit_counters`: first visit, the
    visit before the latest, number of visits."""
    return events.groupBy(*DEVICE).agg(
        F.min("_idts").alias("first_visit"),
        F.max("_viewts").alias("previous_visit"),
        F.max("_idvc").alias("visits"),
        F.count("*").alias("n_events"),
    )


def sessions_per_device(events: DataFrame, **rule) -> DataFrame:
    """Sessions of every device: id, start, end, events."""
    return session_table(sessionize_v2(events, **rule))
