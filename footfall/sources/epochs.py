"""Tables whose rows later batches may restate.

A table holds data files and a log of commits. A commit names the files of one epoch with the
part (day) they belong to; a file that no commit names does not exist for readers. Of rows
with one key, those of the newest epoch hold. So a batch restates a row by writing it again,
nothing is rewritten in place, and an epoch that is replayed replaces its own commit only.

Readers open the files that the log names for the parts they ask for: no folder is listed, and
no statistics of other days are read. `compact` writes what holds now as a base; readers then
leave older epochs alone.
"""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.utils import AnalysisException

_LOG = "epoch BIGINT, base BOOLEAN, part STRING, file STRING, n BIGINT"


def read_if_there(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def same_keys(left: str, right: str, names):
    """Null-safe equality of the aliased sides in all names."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


class EpochTable:
    """`keys` identify what an epoch restates: a row, or a set of rows that is written whole.
    `part` is the column that splits the table into files of their own, such as a day."""

    def __init__(self, spark: SparkSession, path: str, keys, part: str | None = None):
        self.spark, self.path, self.keys, self.part = spark, path, tuple(keys), part

    # -- writing ---------------------------------------------------------------

    def write(self, rows: DataFrame, epoch: int, base: bool = False) -> None:
        """Commit the rows as `epoch`. Written again, an epoch is replaced."""
        part = F.col(self.part).cast("string") if self.part else F.lit(None).cast("string")
        target = f"{self.path}/data/{'base' if base else 'epoch'}-{epoch}-{uuid.uuid4().hex}"
        rows = rows.withColumns({"__epoch": F.lit(epoch).cast("bigint"), "__part": part})
        # one well-sized set of files per part; AQE splits parts that are too large
        rows.hint("rebalance", "__part").write.partitionBy("__part").parquet(target)
        written = read_if_there(self.spark, target)
        if written is None:  # no row at all
            log = self.spark.createDataFrame([], _LOG)
        else:
            log = written.groupBy(F.input_file_name().alias("file"), F.col("__part").cast("string").alias("part")).agg(
                F.count("*").alias("n")).select(
                F.lit(epoch).cast("bigint").alias("epoch"), F.lit(base).alias("base"), "part", "file", "n")
        # the commit: data that no log names is never read
        log.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/{'base' if base else 'epoch'}={epoch}")

    def compact(self, upto: int) -> None:
        """Write the rows that hold after `upto` as a base."""
        rows = self.read(before=upto + 1)
        if rows is not None:
            self.write(rows, upto, base=True)

    # -- reading ---------------------------------------------------------------

    def log(self, before: int | None = None) -> DataFrame | None:
        """The files of all commits, of epochs below `before`; None in a new table."""
        found = None
        for kind in ("base", "epoch"):
            try:
                some = self.spark.read.schema(_LOG).option("recursiveFileLookup", "true").option(
                    "pathGlobFilter", "*.parquet").parquet(f"{self.path}/log/{kind}=*")
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                continue
            found = some if found is None else found.unionByName(some)
        if found is None:
            return None
        return found if before is None else found.where(F.col("epoch") < before)

    def versions(self, parts: DataFrame | None = None, before: int | None = None) -> DataFrame | None:
        """All committed rows with `__epoch`, of the parts in the one column of `parts` only.
        What reaches the driver is the names of the files to open, as for any scan."""
        log = self.log(before)
        if log is None:
            return None
        if parts is not None:
            asked = parts.select(F.col(parts.columns[0]).cast("string").alias("part")).distinct()
            log = log.alias("l").join(asked.alias("r"), same_keys("l", "r", ["part"]), "left_semi")
        named = log.select("epoch", "base", "file").collect()
        # the latest base, and what came after it; a part without rows in the base has none before
        start = max((r.epoch for r in named if r.base), default=-1)
        files = [r.file for r in named if (r.epoch == start if r.base else r.epoch > start)]
        return self.spark.read.parquet(*files) if files else None

    def read(self, parts: DataFrame | None = None, before: int | None = None) -> DataFrame | None:
        """The rows that hold. A key's rows of the newest epoch are kept together."""
        rows = self.versions(parts, before)
        if rows is None:
            return None
        newest = F.max("__epoch").over(W.partitionBy(*[F.col(k) for k in self.keys]))
        return rows.withColumn("__newest", newest).where("__epoch = __newest").drop("__newest", "__epoch")

    def at(self, epoch: int) -> DataFrame | None:
        """The rows of one epoch."""
        rows = self.versions(before=epoch + 1)
        return None if rows is None else rows.where(F.col("__epoch") == epoch).drop("__epoch")
