"""Page, campaign and user state of devices on streams."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.operators.context import attribute_campaign, page_context
from footfall.operators.identity import carry_registration, carry_user, carry_user_property
from footfall.operators.timeline import Timeline
from footfall.schema import DEVICE, SERIAL
from footfall.sources.epochs import EpochTable
from footfall.streaming.triggers import trigger_from_interval

#: Epochs after which the state of all devices is written anew, so that reading it opens few files.
COMPACT = 50

_TEXTS = ("eventName", "eventBody", "url", "title", "userId", "userProperty", "bridgeInfo")
_ROW = (
    *DEVICE, "eventTime", "sn", "eventName", "url", "title", "referrer", "utm", "pushContent", "userId",
    "userProperty", "registrationID", "late",
)


def _state_table(spark: SparkSession, path: str) -> EpochTable:
    return EpochTable(spark, f"{path}/state", DEVICE)


def continue_context(path: str):
    """A `foreachBatch` body: the operators of a batch run, on the rows of one micro-batch, going
    on from the devices' state after the last one. Each epoch leaves its rows and the state of
    the devices in it; a replay starts from the same state and replaces both."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        states = _state_table(spark, path)
        given = [F.col(c) if c in batch.columns else F.lit(None).cast("string").alias(c) for c in _TEXTS]
        rows = batch.where(F.col("eventTime").isNotNull()).select(
            *DEVICE, "eventTime", F.coalesce("sn", F.lit(0)).cast(SERIAL).alias("sn"), *given
        )
        line = Timeline(rows, state=states.read(before=epoch), keep=True)
        line = page_context(attribute_campaign(line))
        line = carry_user_property(carry_user(carry_registration(line))).settled("context")
        line.frame("late").select(*_ROW).write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
        states.write(line.snapshot(), epoch)
        if epoch and epoch % COMPACT == 0:
            states.compact(epoch - 1)

    return run


def stream_context(events: DataFrame, path: str, checkpoint: str, interval_s: float = 20):
    """Start the query that gives url, title, referrer, campaign, user, user property and
    registration id of every event, by `attribute_campaign`, `page_context`,
    `carry_registration`, `carry_user` and `carry_user_property` with one row of state per device.

    The rows of a micro-batch are put in order. One that is older than what its device's state has
    seen already is passed on as it is, with `late` set, for a batch run. Rows without a time are
    left out. Read the result by `read_context`."""
    return (
        events.writeStream.foreachBatch(continue_context(path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_from_interval(interval_s))
        .start()
    )


def read_context(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").select(*_ROW)
