"""Writers that survive replays."""

from pyspark.sql import DataFrame, functions as F

from footfall.operators.commerce import with_order_items
from footfall.operators.delivery import dedupe_events, resend_key
from footfall.operators.filters import not_opted_out, sample_events
from footfall.operators.legacy import legacy_request_time, legacy_static, request_vars, to_legacy
from footfall.plans.rebuild import continue_legacy
from footfall.schema import DEVICE, EVENT_ORDER
from footfall.scratch import new_dir
from footfall.sources.epochs import EpochTable, same_keys
from footfall.sources.events import with_event_date


#: What a later copy of an event may know that an earlier one does not.
FACTS = ("userId", "userProperty")
_UNNUMBERED = "__unnumbered"
_KEYS = (*DEVICE, *EVENT_ORDER, _UNNUMBERED)


def event_table(spark, path: str) -> EpochTable:
    return EpochTable(spark, path, _KEYS, part="event_date")


def read_events(spark, path: str, days: DataFrame | None = None) -> DataFrame | None:
    """The stored events, each as the copies together know it, with `version`, the epoch that
    last had something to add; None before the first. `days` (one date column) names what to open."""
    rows = event_table(spark, path).read(days)
    return None if rows is None else rows.drop(_UNNUMBERED)


def restated(batch: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Events of the batch, without copies, that are new or that know something which the
    stored copy does not; what either knows is kept. The greater value of a fact holds, so
    the order of the copies, and how they fall into batches, makes no difference."""
    batch = dedupe_events(batch)
    batch = batch.withColumn(_UNNUMBERED, resend_key(batch)[-1])
    facts = [c for c in FACTS if c in batch.columns]
    if stored is None:
        return batch
    old = stored.select(*_KEYS, *[F.col(c).alias("__old_" + c) if c in stored.columns else F.lit(None).cast("string").alias("__old_" + c) for c in facts], F.lit(True).alias("__there"))
    joined = batch.alias("n").join(old.alias("o"), same_keys("n", "o", _KEYS), "left")
    merged = {c: F.greatest(F.col("n." + c), F.col("o.__old_" + c)) for c in facts}
    more = F.lit(False)
    for c, value in merged.items():
        more = more | ~value.eqNullSafe(F.col("o.__old_" + c))
    return joined.where(F.col("o.__there").isNull() | more).select(
        *[merged[c].alias(c) if c in merged else F.col("n." + c) for c in batch.columns]
    )


def write_idempotent(batch: DataFrame, epoch: int, path: str) -> None:
    """Store the batch's new events, and restate those that a copy in it knows more about.

    A batch is compared with the stored files of its own days, since a resend has the time of
    its original. A replayed epoch is compared with the epochs before it and replaces its own
    commit, so it ends in the same table. Use as a `foreachBatch` body; read by `read_events`."""
    table = event_table(batch.sparkSession, path)
    batch = with_event_date(batch)
    stored = table.read(parts=batch.select("event_date"), before=epoch)
    rows = restated(batch, stored).withColumn("version", F.lit(epoch).cast("bigint"))
    table.write(rows, epoch)


def legacy_rows(events: DataFrame, tz="UTC") -> DataFrame:
    """Legacy rows of current events, item rows of orders included. Visit counters need all
    earlier events of a device; `plans.rebuild.legacy_table` adds them."""
    return legacy_static(request_vars(legacy_request_time(to_legacy(with_order_items(events)), tz)))


def _replace_epoch(rows: DataFrame, path: str, epoch: int) -> None:
    (
        rows.withColumn("batch_id", F.lit(epoch)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def fan_out(
    events: DataFrame, current_path: str, legacy_path: str, epoch: int = 0, tz="UTC",
    visits_path: str | None = None, opted_out: DataFrame | None = None, rate: int = 100,
) -> None:
    """Write the events to the current table and their mapping to the legacy one.

    Visit counters go on from the epoch before: the table at `visits_path` (by default beside the
    legacy one) has one row per device, and no history is read. Devices that opted out, and events
    outside the sample of `rate`, are left out of the legacy table only, and do not count there.
    A replayed epoch replaces its own rows and state."""
    visits = EpochTable(events.sparkSession, visits_path or f"{legacy_path}-visits", DEVICE)
    events = events.persist()  # the input is read once
    try:
        _replace_epoch(events, current_path, epoch)
        legacy = events.where(F.col("eventTime").isNotNull())
        if opted_out is not None:
            legacy = not_opted_out(legacy, opted_out)
        rows, state = continue_legacy(sample_events(legacy, rate), visits.read(before=epoch), tz)
        _replace_epoch(rows, legacy_path, epoch)
        visits.write(state, epoch)
    finally:
        events.unpersist()


def debug_sink(df: DataFrame, fmt: str = "console", **trigger):
    """Show rows instead of storing them. A stream gives its query, `console` or
    `noop` (reads everything, prints nothing); a table is shown or read through."""
    if df.isStreaming:
        writer = df.writeStream.format(fmt).option("truncate", False)
        writer = writer.option("checkpointLocation", new_dir(df.sparkSession, "debug"))
        return (writer.trigger(**trigger) if trigger else writer).start()
    if fmt == "console":
        return df.show(truncate=False)
    return df.write.format(fmt).mode("overwrite").save()
