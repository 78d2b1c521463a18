"""Whole jobs out of the operators."""

from pyspark.sql import DataFrame, functions as F

from footfall.functions.clock import from_utc_text
from footfall.operators.commerce import with_order_items
from footfall.operators.context import attribute_campaign, page_context
from footfall.operators.delivery import dedupe_events
from footfall.operators.filters import legacy_eligible
from footfall.operators.identity import (
    backfill_user, carry_registration, carry_user, carry_user_property,
)
from footfall.operators.legacy import (
    legacy_request_time, legacy_static, request_vars, to_legacy,
)
from footfall.operators.sessions import sessionize_v1, sessionize_v2, visit_counters
from footfall.operators.timeline import Timeline
from footfall.schema import EVENT_COLUMNS, LEGACY_COLUMNS, SESSION_TIMEOUT_S, USER_HORIZON_S
from footfall.sources.events import split_untimed
from footfall.sources.wire import decode_bulk_v1, decode_bulk_v2


def ingest(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events of readable requests without resent copies, unreadable ones)."""
    decoded = decode_bulk_v2(payloads)
    events, untimed = split_untimed(decoded.where(~F.col("malformed")))
    bad = decoded.where("malformed").unionByName(untimed)
    return dedupe_events(events.select(*EVENT_COLUMNS, "extra")), bad


def ingest_legacy(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(legacy events of readable requests without resent copies, unreadable ones and those
    without a time). A resend repeats everything, the random `r` included; a legacy event has no
    number of its own, so rows are copies when all they hold is equal. Only a digest of it is
    compared, and each map task sends one row per event."""
    decoded = decode_bulk_v1(payloads)
    timed = ~F.col("malformed") & from_utc_text("cdt").isNotNull()
    rows = decoded.where(timed).select(*LEGACY_COLUMNS, "extra")
    held = F.to_json(F.struct(*LEGACY_COLUMNS, "extra"))
    rows = rows.withColumn("__copy", F.md5(held)).dropDuplicates(["__copy"]).drop("__copy")
    return rows, decoded.where(~timed)


def _visits(events: DataFrame, timeout_s: int, **run) -> Timeline:
    return visit_counters(sessionize_v1(Timeline(legacy_eligible(events), **run), timeout_s))


def _legacy(rows: DataFrame, tz) -> DataFrame:
    rows = to_legacy(with_order_items(rows.withColumnRenamed("new_visit", "__opens")))
    rows = request_vars(legacy_request_time(rows, tz))
    return (
        legacy_static(rows)
        .withColumn("new_visit", F.when(F.col("__opens"), "1"))
        .withColumns({c: F.col(c).cast("string") for c in ("_idvc", "_viewts", "_idts")})
        .drop("__opens")
    )


def legacy_table(events: DataFrame, tz="UTC", timeout_s: int = SESSION_TIMEOUT_S, hot=None) -> DataFrame:
    """Legacy rows of current events with everything the legacy client adds:
    mapping, request time, custom variables, visit counters, static fields. An order with
    items gives two rows, the second with its items and revenue."""
    return _legacy(_visits(events, timeout_s, hot=hot).frame(), tz)


def continue_legacy(
    events: DataFrame, state: DataFrame | None, tz="UTC", timeout_s: int = SESSION_TIMEOUT_S, hot=None,
) -> tuple[DataFrame, DataFrame]:
    """`legacy_table` of events that follow those of `state`, and the state after them: the visits
    of each device so far. Events older than the state have no counters."""
    line = _visits(events, timeout_s, hot=hot, state=state, keep=True).settled("visits")
    return _legacy(line.frame(), tz), line.snapshot()


def continue_state(
    events: DataFrame, state: DataFrame | None, timeout_s: int = SESSION_TIMEOUT_S, tz="UTC", hot=None,
) -> tuple[DataFrame, DataFrame]:
    """Session, campaign, page and user state of events that follow those of `state`, and the
    state of their devices after them. Users that a later event names are given back by
    `backfill_between`. Events older than the state are marked in `late`."""
    line = Timeline(events, hot=hot, state=state, keep=True)
    line = page_context(attribute_campaign(sessionize_v2(line, timeout_s, tz)))
    line = carry_registration(line)
    if "userProperty" in events.columns:
        line = carry_user_property(line)
    line = carry_user(line).settled("state")
    return line.frame("late"), line.snapshot()


def rebuild_state(
    events: DataFrame,
    timeout_s: int = SESSION_TIMEOUT_S,
    tz="UTC",
    horizon_s: int = USER_HORIZON_S,
    hot=None,
) -> DataFrame:
    """Session, campaign, page and user state of every event. One Timeline, so
    one exchange and one sort by device for all of it."""
    rows = Timeline(events, hot=hot)
    rows = sessionize_v2(rows, timeout_s, tz)
    rows = page_context(attribute_campaign(rows))
    rows = carry_registration(rows)
    if "userProperty" in rows.columns:
        rows = carry_user_property(rows)
    return backfill_user(carry_user(rows), horizon_s).frame()
