"""Token counts through a digest cache (operator 3).

Texts are joined to the cache by (SHA-256 of the content, SHA-256 of the tokenizer file).
Only distinct misses are encoded, once each, and appended. The counts of all rows then come
from the cache by one join on the digest. Another tokenizer file has another digest, so its
counts never mix with those of an earlier one.

Texts reach the encoder where they were read: the misses are found on digests, the texts of
one row per miss are encoded in Arrow batches, and only digests and counts are shuffled.
"""

import hashlib
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm.pretokens import PartCache, parts
from footfall.llm.tables import digest, hand_over, light, new_dir, text_or_empty, tokenizer_path

CACHE = "text_digest BINARY, tokenizer_digest STRING, n_tokens BIGINT"
_COUNTERS: dict[str, object] = {}


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def counter(path: str):
    """str -> number of tokens, as the file's library gives it; one per process."""
    if path not in _COUNTERS:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _COUNTERS[path] = lambda text: len(model.encode(text, num_threads=1))
        else:
            _COUNTERS[path] = _json_counter(path)
    return _COUNTERS[path]


def _json_counter(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()

    def compute(texts):
        return [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    if not _cuts_are_safe(path):
        return lambda text: compute([text])[0]
    cache = PartCache(compute)
    return lambda text: sum(cache.values(parts(text)))


def _cuts_are_safe(path: str) -> bool:
    """Whether parts can be encoded alone: plain byte-level BPE without a normaliser, and
    no added token that takes in or spans white space."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    added = spec.get("added_tokens") or []
    return bool(
        plain and spec.get("normalizer") is None and spec.get("post_processor") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"] != "".join(t["content"].split()) for t in added)
    )


def _encode(path: str):
    def run(batches):
        count = counter(path)
        for batch in batches:
            n = [count(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("text_digest"), pa.array(n, pa.int64())], names=["text_digest", "n_tokens"]
            )

    return run


def _vocabulary(name: str):
    """The file at its place on the executor that asks."""

    def run(batches):
        return _encode(tokenizer_path(name))(batches)

    return run


class CountCache:
    """Stored counts; the same `path` opens them again in another session."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], CACHE).write.mode("append").parquet(path)

    def rows(self, tokenizer: str) -> DataFrame:
        # a run that was cut off and started again may have stored a count twice
        stored = self.spark.read.schema(CACHE).parquet(self.path).where(F.col("tokenizer_digest") == tokenizer)
        return stored.groupBy("text_digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        counts.select(
            "text_digest", F.lit(tokenizer).alias("tokenizer_digest"), F.col("n_tokens").cast("bigint").alias("n_tokens")
        ).write.mode("append").parquet(self.path)


def open_cache(spark: SparkSession) -> CountCache:
    return CountCache(spark, new_dir(spark, "token-counts"))


def count_tokens(docs: DataFrame, cache: CountCache, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Whole texts; null counts as empty and has no tokens. Equal texts are encoded once: the
    one with the smallest id, and of repeated (id, text) rows each. Null and repeated ids are
    rows like any other; an empty table gives an empty result; other columns are ignored.
    """
    version = tokenizer_digest(tokenizer_path(tokenizer))
    row_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1).cast("bigint"))
    keyed = hand_over(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            row_id.alias("row_id"),
            digest().alias("text_digest"),
            F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"),
        ),
        "token-digests",
    )
    first = keyed.groupBy("text_digest").agg(F.min("row_id").alias("row_id"), F.count("*").alias("copies"))
    known = cache.rows(version).select("text_digest")
    misses = hand_over(first.join(known, "text_digest", "left_anti"), "token-misses")
    wanted = misses.select("row_id", "text_digest")
    others = keyed.join(wanted, ["row_id", "text_digest"], "left_anti").select("row_id", "text_digest").distinct()
    others = hand_over(others, "token-others")
    # the texts to encode, by whichever list is shorter
    n, m = wanted.count(), others.count()
    side, how = (wanted, "left_semi") if n <= m else (others, "left_anti")
    texts = docs.select(row_id.alias("row_id"), digest().alias("text_digest"), text_or_empty().alias("text"))
    texts = texts.join(light(side, min(n, m)), ["row_id", "text_digest"], how).select("text_digest", "text")
    cache.append(texts.mapInArrow(_vocabulary(tokenizer), "text_digest BINARY, n_tokens BIGINT"), version)
    counts = hand_over(cache.rows(version), "token-cache")  # plain exchange, so hot digests can be split
    return keyed.join(counts, "text_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
