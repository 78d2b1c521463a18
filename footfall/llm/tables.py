"""Helpers the operators share: given tables, text digests, distributed numbering."""

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from footfall.scratch import hand_over, new_dir  # noqa: F401

#: White space of the word rules: blank, and tab to carriage return.
SPACE = r"\x20\x09-\x0D"

#: Rows that one window partition of `numbered` sorts, buckets of small tables, and buckets
#: whose sizes are added up at a time.
ROWS_PER_BUCKET, BUCKETS, BLOCK = 50_000, 64, 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text="text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def digest(text="text") -> Column:
    """32 bytes of SHA-256 over the UTF-8 text; null counts as empty."""
    return F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256))


def numbered(df: DataFrame, name: str, order, within=(), first=(), rows: int | None = None) -> DataFrame:
    """Gapless numbers from 0, by a hash order; in each `within` group by `first` and then that.

    A plain row number would sort a whole group in one task. Here rows fall into hash buckets of
    about `ROWS_PER_BUCKET` rows; the bucket counts are added up first, and rows are numbered inside
    their bucket only. The place of a row in a table that is written first is part of the hash,
    so a row that is repeated very often is dealt to all buckets. Without `within`, counts are
    added up by blocks of buckets, whose totals (one for each BLOCK * ROWS_PER_BUCKET rows) are
    all that reaches the driver. `rows` saves the count when it is known.
    """
    columns = df.columns
    df = hand_over(df.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    total = df.count() if rows is None else rows
    buckets = max(BUCKETS, total // ROWS_PER_BUCKET)
    df = df.withColumn("__b", F.pmod(F.xxhash64(*order, "__at"), F.lit(buckets)))
    cell = [*within, *first, "__b"]
    counts = df.groupBy(*cell).agg(F.count("*").alias("__n"))
    if within:
        before, steps = W.partitionBy(*within), [*first, "__b"]
    else:
        counts = hand_over(counts.withColumn("__block", F.floor(F.col("__b") / BLOCK)), "bucket-sizes")
        before, steps = W.partitionBy("__block"), ["__b"]
    so_far = F.sum("__n").over(before.orderBy(*steps).rowsBetween(W.unboundedPreceding, W.currentRow))
    starts = counts.withColumn("__start", so_far - F.col("__n"))
    if not within:
        totals, at, ahead = counts.groupBy("__block").agg(F.sum("__n").alias("m")).collect(), 0, []
        for block, m in sorted((r["__block"], r["m"]) for r in totals):
            ahead.append((block, at))
            at += m
        listed = df.sparkSession.createDataFrame(ahead, "__block BIGINT, __ahead BIGINT")
        starts = starts.join(F.broadcast(listed), "__block").withColumn("__start", F.col("__start") + F.col("__ahead"))
    inside = F.row_number().over(W.partitionBy(*cell).orderBy(*order, "__at")) - 1
    same = [F.col("l." + c).eqNullSafe(F.col("r." + c)) for c in cell]
    joined = df.withColumn("__i", inside).alias("l").join(starts.select(*cell, "__start").alias("r"), same, "left")
    return joined.select(*[F.col("l." + c) for c in columns], (F.col("r.__start") + F.col("l.__i")).alias(name))


#: Rows of narrow tables (ids and digests) that may be broadcast: some 50 MB.
BROADCAST_ROWS = 1_000_000


def light(df: DataFrame, rows: int) -> DataFrame:
    """Hinted for broadcast only when its counted rows are few; else Spark shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def only_chosen(docs: DataFrame, judged: DataFrame, chosen: DataFrame, kind: str) -> DataFrame:
    """`docs` without the rows of `judged` that are not `chosen`; both have doc_id and `kind`, the
    name of a digest of the text: `text_id` (xxhash64) or `digest`. Of rows that repeat a chosen
    id and text one stays, so of a group of copies never two do."""
    taken = {c.lower() for c in docs.columns}
    name = next(n for n in (f"__{kind}{i}" for i in range(99)) if n not in taken)
    made = F.xxhash64(text_or_empty()) if kind == "text_id" else digest()
    counted = judged.groupBy("doc_id", kind).agg(F.count("*").alias("n"))
    named = chosen.select("doc_id", kind, F.lit(True).alias("stays")).distinct()
    same = F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col(f"c.{kind}").eqNullSafe(F.col(f"s.{kind}"))
    verdicts = counted.alias("c").join(named.alias("s"), same, "left").where("stays IS NULL OR n > 1")
    verdicts = hand_over(verdicts.select("c.doc_id", f"c.{kind}", "stays"), "verdicts")
    rows = docs.withColumn(name, made)

    def match(side: DataFrame, how: str) -> DataFrame:
        listed = light(side, side.count()).alias("v")
        on = F.col("r.doc_id").cast("bigint").eqNullSafe(F.col("v.doc_id")) & F.col(f"r.{name}").eqNullSafe(F.col(f"v.{kind}"))
        return rows.alias("r").join(listed, on, how)

    rest = match(verdicts.select("doc_id", kind), "left_anti")
    twice = verdicts.where("stays").select("doc_id", kind)
    if twice.isEmpty():
        return rest.drop(name)
    single = match(twice, "left_semi").dropDuplicates(["doc_id", name])
    return rest.unionByName(single).drop(name)


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file lies on the machine that asks."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
