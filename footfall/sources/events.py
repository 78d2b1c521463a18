"""Read stored events."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.schema import EVENT_SCHEMA


def scan_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored events with the fixed schema; a partition column such as
    `event_date` is kept, so filters on it prune folders."""
    return spark.read.format(fmt).schema(EVENT_SCHEMA).load(path)


def stream_events(
    spark: SparkSession, path: str, fmt: str = "parquet", bytes_per_trigger: int = 1 << 30,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same table as a stream of new files. What one trigger reads is bounded,
    because operators with device state order a device's share of it in one task;
    those that only filter or parse can take more."""
    reader = spark.readStream.format(fmt).schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path)


def with_event_date(events: DataFrame) -> DataFrame:
    """Day of the event in UTC, the column event tables are partitioned by."""
    day = F.floor(F.col("eventTime") / 86_400_000)
    # a time outside the calendar (year 1 to 9999) has no day; it must not stop the job
    inside = F.when(day.between(-719_162, 2_932_896), day).cast("int")
    return events.withColumn("event_date", F.date_add(F.lit("1970-01-01").cast("date"), inside))


def split_untimed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events with a time, events without one). The second goes to quarantine:
    rows without a time have no place in the order of a device."""
    timed = F.col("eventTime").isNotNull()
    return events.where(timed), events.where(~timed)
