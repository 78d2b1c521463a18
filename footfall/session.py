"""Session settings the operators are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # joins on a device key: split partitions that one device makes too large
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the n first rows of a group are picked in the map tasks, whatever n is
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
    # HotSpot never compiles longer methods; wide projections over event columns
    # exceed that, and run faster without whole-stage code than interpreted in it
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # merge the sessions of a device inside each map task before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # texts are long: what a Python worker holds at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # device state of streams outside the JVM heap, with incremental checkpoints
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession, **overrides) -> SparkSession:
    for name, value in {**SETTINGS, **overrides}.items():
        spark.conf.set(name, value)
    return spark
