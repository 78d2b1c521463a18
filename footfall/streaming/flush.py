"""Streams into tables and requests."""

from pyspark.sql import DataFrame, functions as F

from footfall.operators.identity import backfill_user
from footfall.schema import EVENTS_PER_REQUEST, USER_HORIZON_S
from footfall.sources.sinks import event_table, fan_out, write_idempotent
from footfall.sources.wire import encode_bulk
from footfall.streaming.triggers import trigger_from_interval


def flush_to(
    events_path: str, requests_path: str | None = None, n: int = EVENTS_PER_REQUEST, send=None
):
    """A `foreachBatch` body: store the new events, and turn exactly those into requests of n,
    an event that a later copy knows more about once more. A replayed epoch replaces its own
    output in both tables. `send(requests, epoch)` gets the stored requests; it may see an
    epoch again."""

    def flush(batch: DataFrame, epoch: int) -> None:
        write_idempotent(batch, epoch, events_path)
        added = event_table(batch.sparkSession, events_path).at(epoch) if requests_path else None
        if added is not None:
            target = f"{requests_path}/batch_id={epoch}"
            encode_bulk(added, n).write.mode("overwrite").parquet(target)
            if send:
                send(batch.sparkSession.read.parquet(target), epoch)

    return flush


def stream_flush(
    events: DataFrame,
    events_path: str,
    requests_path: str | None,
    checkpoint: str,
    interval_s: float = 20,
    n: int = EVENTS_PER_REQUEST,
):
    """Start the query that drains a stream of events."""
    return (
        events.writeStream.foreachBatch(flush_to(events_path, requests_path, n))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_from_interval(interval_s))
        .start()
    )


def stream_best_copies(events: DataFrame, events_path: str, checkpoint: str, interval_s: float = 20):
    """Start the query that removes resent copies and corrects itself: the state is the table, an
    event's row holds what its copies so far know, and an epoch gives the rows that a copy in it
    changed, with the epoch as `version` (`sinks.event_table(...).at(epoch)`). Copies may come at
    any distance of time; only the days in a micro-batch are compared."""
    return (
        events.writeStream.foreachBatch(lambda batch, epoch: write_idempotent(batch, epoch, events_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_from_interval(interval_s))
        .start()
    )


def stream_fan_out(events, current_path, legacy_path, checkpoint, interval_s: float = 20, tz="UTC"):
    """Start the query that writes every event to both protocols' tables."""
    return (
        events.writeStream.foreachBatch(
            lambda batch, epoch: fan_out(batch, current_path, legacy_path, epoch, tz)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_from_interval(interval_s))
        .start()
    )


def late_user_attach(
    stored: DataFrame, since_ms: int, until_ms: int, horizon_s: int = USER_HORIZON_S, hot=None
) -> DataFrame:
    """Stored events of [since, until) that gain a user when those up to
    `horizon_s` later are known, with that user. Only this time range is read; where the
    table has an `event_date`, only its folders."""
    last_ms = until_ms + horizon_s * 1000
    span = stored.where((F.col("eventTime") >= since_ms) & (F.col("eventTime") < last_ms))
    if "event_date" in stored.columns:
        first, last = (F.date_add(F.lit("1970-01-01").cast("date"), F.lit(ms // 86_400_000)) for ms in (since_ms, last_ms))
        span = span.where(F.col("event_date").between(first, last))
    anonymous = F.col("userId").isNull()
    restated = backfill_user(span.withColumn("__was", anonymous), horizon_s, hot=hot)
    gained = F.col("__was") & F.col("userId").isNotNull() & (F.col("eventTime") < until_ms)
    return restated.where(gained).drop("__was")
