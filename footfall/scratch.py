"""Shared folder for stream checkpoints and hand-over tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return named


def new_dir(spark: SparkSession, label: str) -> str:
    """A folder name below the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def hand_over(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows by way of a table in the shared folder: computed once, columnar,
    and still there when an executor is lost. `by` names the last column, to keep its values
    in folders of their own."""
    path = new_dir(df.sparkSession, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
