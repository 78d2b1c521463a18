"""Events stored for device state: dealt and sorted by device, with counts of busy devices.

A table of days, each in buckets by device, is read without an exchange by everything that
works per device. Beside it lies a small table of how many events the busy devices had on each
day, made when a day is stored, so that plans over any days need no count to find hot devices.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.operators.timeline import HOT_ROWS, NO_HOT_KEYS, SLICES_PER_LIMIT, HotKeys
from footfall.schema import DEVICE, EVENT_ORDER
from footfall.sources.epochs import EpochTable
from footfall.sources.events import with_event_date

#: Events of one day from which a device is counted. A device that stays below on all days of
#: a long range may be large and not listed; its windows are then one sort as of any other.
BUSY = HOT_ROWS // 1000


def _counts(spark: SparkSession, path: str) -> EpochTable:
    return EpochTable(spark, f"{path}-busy", (*DEVICE, "event_date"), "event_date")


class DeviceStore:
    """A catalog table `name` with its files at `path`, in `buckets` buckets by device. Choose
    their number so that a bucket of the days read at once fits a task."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def append(self, events: DataFrame, batch: int, busy: int = BUSY) -> None:
        """Store days, and the counts of their busy devices; `batch` numbers the calls. The events of
        a batch that is stored twice are there twice, its counts once."""
        rows = with_event_date(events)
        counts = rows.groupBy(*DEVICE, "event_date").agg(F.count("*").alias("n")).where(F.col("n") >= busy)
        _counts(self.spark, self.path).write(counts, batch)
        (
            # a file for each bucket and day
            rows.repartition(self.buckets, *DEVICE)
            .write.mode("append").option("path", self.path)
            .partitionBy("event_date").bucketBy(self.buckets, *DEVICE).sortBy(*DEVICE, *EVENT_ORDER)
            .saveAsTable(self.name)
        )

    def scan(self, first=None, last=None) -> DataFrame:
        """The stored events, from day to day."""
        rows = self.spark.table(self.name)
        for day, keep in ((first, F.col("event_date") >= F.lit(first)), (last, F.col("event_date") <= F.lit(last))):
            rows = rows if day is None else rows.where(keep)
        return rows

    def hot(self, first=None, last=None, floor: int = HOT_ROWS) -> HotKeys:
        """The hot devices of the days, out of the stored counts alone: `hot` of any operator."""
        counts = _counts(self.spark, self.path).versions()
        if counts is None:
            return NO_HOT_KEYS
        for day, keep in ((first, F.col("event_date") >= F.lit(first)), (last, F.col("event_date") <= F.lit(last))):
            counts = counts if day is None else counts.where(keep)
        keys = counts.groupBy(*DEVICE).agg(F.sum("n").alias("n")).where(F.col("n") >= floor)
        rows = keys.agg(F.sum("n")).first()[0] or 0
        return HotKeys(keys.select(*DEVICE), rows, max(1, floor // SLICES_PER_LIMIT)) if rows else NO_HOT_KEYS
