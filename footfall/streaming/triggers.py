"""Run streams."""

from pyspark.sql import DataFrame

from footfall.scratch import new_dir


def trigger_from_interval(seconds: float) -> dict:
    """Arguments for `DataStreamWriter.trigger`: above 0 a timer, 0 as soon as
    there is data, below 0 only when started (what is there, then stop)."""
    if seconds > 0:
        return {"processingTime": f"{int(seconds * 1000)} milliseconds"}
    if seconds == 0:
        return {"processingTime": "0 seconds"}
    return {"availableNow": True}


def run_available(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process what the source holds now and return the table at `path`. In
    `complete` mode each epoch replaces the table, otherwise it adds a folder
    of its own, which a replay of the epoch replaces."""
    spark = stream.sparkSession

    def store(batch, epoch):
        target = path if mode == "complete" else f"{path}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(target)

    (
        stream.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", new_dir(spark, "stream"))
        .trigger(**trigger_from_interval(-1))
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)
