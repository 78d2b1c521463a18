"""Sessions and duplicates on streams."""

from pyspark.sql import DataFrame, functions as F

from footfall.functions.clock import day_number
from footfall.operators.delivery import resend_key
from footfall.operators.sessions import restarts_session, session_id, sessions_per_device
from footfall.operators.timeline import NO_HOT_KEYS, Timeline
from footfall.schema import DEVICE, EVENT_ORDER, SERIAL, SESSION_TIMEOUT_S
from footfall.scratch import hand_over
from footfall.sources.epochs import EpochTable, same_keys
from footfall.streaming.triggers import trigger_from_interval


#: Milliseconds of the years 1 to 9999; device clocks outside have no timestamp.
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def with_event_ts(events: DataFrame) -> DataFrame:
    at = F.col("eventTime")
    return events.withColumn("event_ts", F.when(at.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(at)))


def stream_sessions(
    events: DataFrame,
    timeout_s: int = SESSION_TIMEOUT_S,
    tz="UTC",
    watermark: str = "1 hour",
    prefix: str = "",
    ahead: str = "1 day",
) -> DataFrame:
    """Session rows by silence and calendar day, same as the batch rule without
    restarting events. A session window still joins events that are exactly its
    gap apart, hence one millisecond less. Also runs on a plain table.

    Events further `ahead` of the clock than that are left out, so that one wrong device
    does not move the watermark past everyone's events. These events, and those behind the
    watermark, are put right by `corrected_sessions`."""
    gap = F.session_window("event_ts", f"{timeout_s * 1000 - 1} milliseconds")
    rows = with_event_ts(events).where(F.col("event_ts") <= F.current_timestamp() + F.expr(f"INTERVAL {ahead}"))
    rows = rows.withColumn("__day", day_number("eventTime", tz))
    return (
        rows.withWatermark("event_ts", watermark)
        .groupBy(*DEVICE, "__day", gap)
        .agg(
            F.min("eventTime").alias("seStartTime"),
            F.max("eventTime").alias("last_event"),
            F.count("*").alias("n_events"),
        )
        .drop("__day", "session_window")
        .withColumn("sessionId", session_id(prefix=prefix))
    )


#: A session never goes over midnight, so what a late event can change lies in its device's day.
_DAY = (*DEVICE, "day")
_PLACE = ("at", "sn")


def slim_events(events: DataFrame, tz="UTC") -> DataFrame:
    """What sessions need of the events that have a time."""
    return events.where(F.col("eventTime").isNotNull()).select(
        *DEVICE, day_number("eventTime", tz).alias("day"), F.col("eventTime").alias("at"),
        F.coalesce("sn", F.lit(0)).cast(SERIAL).alias("sn"), restarts_session().alias("restarts"),
    )


def _fragments(slim: DataFrame) -> DataFrame:
    """Each event as a piece of a session: where it begins and ends, whether it begins anew."""
    place = F.struct(*_PLACE)
    return slim.select(*_DAY, place.alias("first"), place.alias("last"), F.lit(1).cast("bigint").alias("n"), F.col("restarts").alias("opens"))


def _to_recut(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored sessions with a fresh restarting event inside, which ends them earlier."""
    inside = Timeline(
        stored.select(*_DAY, F.col("first.at").alias("at"), F.col("first.sn").alias("sn"), F.struct("first", "last").alias("session"))
        .unionByName(fresh.where("restarts").select(*_DAY, *_PLACE), allowMissingColumns=True),
        _DAY, _PLACE, NO_HOT_KEYS,
    ).before(__in=F.col("session")).frame()
    place = F.struct(*_PLACE)
    hit = F.col("session").isNull() & (place > F.col("__in.first")) & (place <= F.col("__in.last"))
    return inside.where(hit).select(*_DAY, "__in.*").distinct()


def stitch(stored: DataFrame | None, fresh: DataFrame, timeout_s: int, earlier=None) -> DataFrame:
    """Sessions of the device days that have fresh events (`slim_events`), from those stored.

    A stored session is an interval without a gap of `timeout_s`, so events that fall into it only
    add to its count, and events near its ends stretch or join it. Only one that restarts sessions
    can cut a stored one; then that session's own events are needed, which `earlier(days)` reads."""
    pieces = _fragments(fresh)
    if stored is not None:
        days = fresh.select(*_DAY).distinct()
        stored = stored.alias("s").join(days.alias("d"), same_keys("s", "d", _DAY), "left_semi")
        if earlier is not None:
            cut = hand_over(_to_recut(stored, fresh), "recut")
            if not cut.isEmpty():
                same = same_keys("s", "c", (*_DAY, "first"))
                stored = stored.alias("s").join(cut.alias("c"), same, "left_anti")
                within = same_keys("e", "c", _DAY) & F.struct("e.at", "e.sn").between(F.col("c.first"), F.col("c.last"))
                events = earlier(cut.select("day"))
                pieces = pieces.unionByName(_fragments(events.alias("e").join(cut.alias("c"), within).select("e.*")))
        pieces = pieces.unionByName(stored.select(*pieces.columns))
    line = Timeline(pieces.withColumns({"at": F.col("first.at"), "sn": F.col("first.sn")}), _DAY, _PLACE)
    new = F.col("opens") | F.col("reach").isNull() | (F.col("at") - F.col("reach") >= timeout_s * 1000)
    line = line.fill(peak={"reach": F.col("last.at")}).total(number=new.cast("bigint"))
    return line.frame().groupBy(*_DAY, "number").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"),
        F.min_by("opens", F.struct("at", "sn", ~F.col("opens"))).alias("opens"),
    ).drop("number")


def _tables(spark, path: str) -> tuple[EpochTable, EpochTable]:
    return EpochTable(spark, f"{path}/sessions", _DAY, "day"), EpochTable(spark, f"{path}/events", _DAY, "day")


def continue_sessions(path: str, timeout_s: int = SESSION_TIMEOUT_S, tz="UTC", triggers: bool = True):
    """A `foreachBatch` body that stitches the events of an epoch into the stored sessions. It
    reads the days that have events, and writes the device days that changed."""

    def run(batch: DataFrame, epoch: int) -> None:
        sessions, events = _tables(batch.sparkSession, path)
        fresh = hand_over(slim_events(batch, tz), "fresh")
        if not triggers:
            fresh = fresh.withColumn("restarts", F.lit(False))
        stored = sessions.read(fresh.select("day"), before=epoch)
        found = stitch(stored, fresh, timeout_s, (lambda days: events.versions(days, before=epoch)) if triggers else None)
        sessions.write(found, epoch)
        if triggers:
            events.write(fresh, epoch)

    return run


def _start(events: DataFrame, body, checkpoint: str, interval_s: float):
    writer = events.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_from_interval(interval_s)).start()


def stream_stitched_sessions(
    events: DataFrame, path: str, checkpoint: str, timeout_s: int = SESSION_TIMEOUT_S, tz="UTC", interval_s: float = 20,
):
    """Start the query that keeps the sessions by silence and calendar day at `path`. Events may
    come in any order and with any clock: nothing is dropped, and after every epoch the table
    equals the batch rule without restarting events on all that has come. Events without a time
    belong to no session. Read it by `read_sessions`."""
    return _start(events, continue_sessions(path, timeout_s, tz, triggers=False), checkpoint, interval_s)


def stream_sessions_with_triggers(
    events: DataFrame, path: str, checkpoint: str, timeout_s: int = SESSION_TIMEOUT_S, tz="UTC", interval_s: float = 20,
):
    """The same by the full batch rule, restarting events included. The events' times are kept
    beside the sessions, and opened only for the sessions that a late restarting event cuts."""
    return _start(events, continue_sessions(path, timeout_s, tz), checkpoint, interval_s)


def read_sessions(spark, path: str, prefix: str = "") -> DataFrame:
    rows = _tables(spark, path)[0].read()
    return rows.select(
        *DEVICE, F.col("first.at").alias("seStartTime"), F.col("last.at").alias("last_event"), F.col("n").alias("n_events"),
    ).withColumn("sessionId", session_id(prefix=prefix))


def corrected_sessions(sessions: DataFrame, events: DataFrame, **rule) -> DataFrame:
    """The stream's final session rows made equal to the batch rule on the stored `events`.

    A device whose sessions hold another number of events than are stored had late events or a
    wrong clock. All of its sessions are built anew; those of other devices stay. Only counts
    are shuffled for the comparison. `rule` goes to `sessionize_v2`."""
    events = events.where(F.col("eventTime").isNotNull())
    counted = sessions.groupBy(*DEVICE).agg(F.sum("n_events").alias("__counted"))
    stored = events.groupBy(*DEVICE).agg(F.count("*").alias("__stored")).alias("s")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in DEVICE]
    astray = (
        stored.join(counted.alias("c"), same, "left")
        .where(~F.col("__stored").eqNullSafe(F.col("__counted")))
        .select(*(F.col(f"s.{c}").alias(c) for c in DEVICE)).alias("a")
    )

    def split(rows, how):
        return rows.alias("r").join(astray, [F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}")) for c in DEVICE], how)

    again = sessions_per_device(split(events, "left_semi"), **rule)
    return split(sessions, "left_anti").unionByName(again.select(*sessions.columns))


def stream_dedupe(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop resent copies that arrive within `delay` of each other; the state holds one key per
    event of that time. `delay` is on the clock of arrival, so no device's clock makes other
    events late, and nothing but copies is dropped."""
    keyed = events.withColumns({"__arrived": F.current_timestamp(), "__unnumbered": resend_key(events)[-1]})
    names = [*DEVICE, *EVENT_ORDER, "__unnumbered"]
    return (
        keyed.withWatermark("__arrived", delay)
        .dropDuplicatesWithinWatermark(names)
        .drop("__arrived", "__unnumbered")
    )
