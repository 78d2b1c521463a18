"""Exact deduplication against a persistent digest index (operator 1).

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the text. A
batch is reduced to one row per digest (combined in the map tasks, so a group of copies
costs one row per task), anti-joined with the index bucket by bucket - a sort-merge join
that does not shuffle the index - and what is left is appended. Decisions then come from
the index by one more join, whose batch side Spark splits where a digest is hot.

Only digests and ids are shuffled, never texts. A batch that failed after its append can
run again: its digests are found in the index with the same row to keep.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm.tables import digest, hand_over, new_dir, only_chosen

INDEX_COLUMNS = "digest BINARY, keep_id BIGINT"


class DigestIndex:
    """Digests seen so far, with the id of the row that stays.

    The same `path` and `buckets` open an index again in another session.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({INDEX_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Add the digests that the index does not hold yet."""
        known = self.rows().select("digest").hint("merge")
        fresh = groups.select("digest", "keep_id").join(known, "digest", "left_anti")
        # one file per bucket and batch
        fresh.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def dedup(docs: DataFrame, index: DigestIndex, id_column="doc_id", text_column="text") -> DataFrame:
    """Decide for every row of a batch, and add the batch to the index.

    Returns one row per row of `docs`: doc_id, keep_id, group_size (rows of this batch with
    the text), kept, text_sha256. Texts are equal when identical; null counts as empty. Of
    equal texts in a batch the largest id stays; a text from an earlier batch beats any
    later row. Null ids lose against any id; if a group has none but null ids, keep_id is
    null and all its rows stay. Rows that repeat both id and text are one document and all
    carry its decision. An empty table gives an empty result. Other columns are ignored.
    """
    keyed = hand_over(
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"), digest(text_column).alias("digest")),
        "digests",
    )
    groups = hand_over(
        keyed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "digest-groups",
    )
    index.append(groups)
    # narrow rows; both sides are plain exchanges, so a hot digest is split by Spark
    decided = hand_over(
        groups.join(index.rows().withColumnRenamed("keep_id", "held_id"), "digest"), "digest-decisions"
    ).select("digest", F.col("held_id").alias("keep_id"), "group_size")
    return keyed.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def open_index(spark: SparkSession) -> DigestIndex:
    """A new, empty index in the shared folder."""
    return DigestIndex(spark, new_dir(spark, "digest-index"))


def keep_first_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one of each text, as `dedup` decides;
    of rows that repeat the id too, or that all have none, any one."""
    rows = hand_over(dedup(docs, index).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept"), "copies")
    return only_chosen(docs, rows.select("doc_id", "digest"), rows.where("kept").select("doc_id", "digest"), "digest")
