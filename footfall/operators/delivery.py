"""Ordering, batching, queue limits and removal of resent events."""

from pyspark.sql import DataFrame, Window as W, functions as F

from footfall.operators.legacy import parse_lifetime_seq
from footfall.operators.timeline import Timeline
from footfall.schema import (
    DEVICE, EVENT_ORDER, EVENTS_PER_REQUEST, MAX_QUEUED_EVENTS, SERIAL, SERIAL_MAX,
)

def order_v2(events: DataFrame) -> DataFrame:
    """Whole table by (event time, serial number), a missing number as 0."""
    return events.orderBy("eventTime", F.coalesce("sn", F.lit(0)))


def order_v1(legacy: DataFrame) -> DataFrame:
    """Whole table by (cdt text, Lifetime_seq), rows without the latter last."""
    ties = [c for c in ("position",) if c in legacy.columns]
    return parse_lifetime_seq(legacy).orderBy("cdt", F.col("lifetime_seq").asc_nulls_last(), *ties)


#: Groups of map tasks whose candidates meet first, so that a device with rows in m tasks sends
#: n rows from each of SLICES groups to its last task, and a group's task gets n * m / SLICES.
SLICES = 64


def _oldest(events: DataFrame, n: int, keys, order) -> DataFrame:
    # Spark keeps the first n rows per key in every map task before each shuffle
    # (WindowGroupLimit; `configure` allows it for any n)
    def first(rows, by):
        place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
        return rows.withColumn("queue_position", place).where(F.col("queue_position") <= n)

    sliced = events.withColumn("__slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
    return first(first(sliced, (*keys, "__slice")).drop("__slice", "queue_position"), keys)


def take_oldest(events: DataFrame, n: int, keys=DEVICE, order=EVENT_ORDER) -> DataFrame:
    """The n oldest events per device; `has_more` tells whether others wait."""
    fetched = _oldest(events, n + 1, keys, order)
    whole = W.partitionBy(*keys)
    fetched = fetched.withColumn("has_more", F.max("queue_position").over(whole) > n)
    return fetched.where(F.col("queue_position") <= n)


def cap_per_device(
    events: DataFrame, limit: int = MAX_QUEUED_EVENTS, flush=(), keys=DEVICE, order=EVENT_ORDER
) -> DataFrame:
    """What a device queue of `limit` events holds: a full queue refuses the
    newest. `flush` names columns that start a new queue, such as a date."""
    return _oldest(events, limit, (*keys, *flush), order).drop("queue_position")


def batch_index(
    events: DataFrame, n: int = EVENTS_PER_REQUEST, keys=DEVICE, order=EVENT_ORDER, hot=None
) -> DataFrame:
    """`batch`: which request an event goes out with, counted from 0."""
    numbered = Timeline(events, keys, order, hot).total(batch=F.lit(1).cast("bigint"))
    return numbered.set(batch=F.floor((F.col("batch") - 1) / n)).frame()


def assign_sn(events: DataFrame, order=EVENT_ORDER, keys=DEVICE, hot=None) -> DataFrame:
    """Number the events of a device where the number is missing: the counter goes on from
    the last number given before, or starts at 1, and wraps to 1 after the largest
    unsigned 64-bit value."""
    count, given = F.col("__count"), F.col("__given")
    numbered = (
        Timeline(events, keys, order, hot)
        .total(__count=F.lit(1).cast("bigint"))
        .before(__given=F.when(F.col("sn").isNotNull(), F.struct(count.alias("at"), F.col("sn").alias("sn"))))
    )
    most = F.lit(str(SERIAL_MAX)).cast("decimal(22,0)")
    on = F.coalesce(given["sn"], F.lit(0)).cast("decimal(21,0)") + (count - F.coalesce(given["at"], F.lit(0)))
    wrapped = F.when(on > most, on - most).otherwise(on).cast(SERIAL)
    return numbered.set(sn=F.coalesce("sn", wrapped)).drop("__count", "__given").frame()


def queue_depth(events: DataFrame, limit: int = MAX_QUEUED_EVENTS, keys=DEVICE) -> DataFrame:
    """Waiting events per device, and whether its queue is full."""
    return (
        events.groupBy(*keys)
        .agg(F.count("*").alias("depth"))
        .withColumn("full", F.col("depth") >= limit)
    )


def resend_key(events: DataFrame) -> list:
    """Columns that two copies of one event share. Serial numbers start again
    after a reinstall, so the time is part of the key; events without a number
    are told apart by what they hold."""
    unnumbered = F.when(
        F.col("sn").isNull(), F.md5(F.to_json(F.struct("eventName", "eventBody", "url", "title")))
    )
    return [*[F.col(c) for c in (*DEVICE, *EVENT_ORDER)], unnumbered]


def dedupe_events(events: DataFrame) -> DataFrame:
    """Drop resent copies. A user or a property can be attached between two sends, so the one row
    that stays knows what any copy knows (of different values the greatest). Each map task sends
    one row per event at most."""
    known = [c for c in ("userId", "userProperty") if c in events.columns]
    keyed = events.withColumn("__unnumbered", resend_key(events)[-1])
    keys = [*DEVICE, *EVENT_ORDER, "__unnumbered"]
    # in a struct NULL is the smallest, so what knows more comes last
    best = F.max_by(F.struct(*events.columns), F.struct(F.lit(0), *known))
    grouped = keyed.groupBy(*keys).agg(best.alias("__best"), *[F.max(c).alias("__" + c) for c in known])
    return grouped.select(
        *[F.col("__" + c if c in known else f"__best.{c}").alias(c) for c in events.columns]
    )
