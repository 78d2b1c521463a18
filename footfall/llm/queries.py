"""One query per operator on the whole given tables, and SQL where it can say the same."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm import (
    bpe, chat, exact_dedup, lm_scoring, minhash_dedup, periodic_runs, phrases, quality_rules, sharding,
    source_mixing, suffix_dedup, token_counts, toxicity,
)
from footfall.llm.tables import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), exact_dedup.open_index(spark))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.open_cache(spark))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


#: A conversation of control strings that every run formats besides the table's.
CONTROL = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    return chat.summarise(chat.format_chats(given.unionByName(extra)))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"), plant=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_minhash_dedup, op3_token_counts, op4_lm_scoring, op5_source_mixing,
        op6_sharding, op7_quality_rules, op8_bpe_codec, op9_suffix_array_dedup, op10_chat_format,
        op11_toxicity, op12_phrase_mining, op13_periodic_runs,
    )
}

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_phrase_mining": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, k, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
        total AS (SELECT lang, sum(n)::BIGINT AS total FROM f WHERE k = 1 GROUP BY lang),
        candidates AS (
            SELECT lang, k, phrase, n, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 30),
        cuts AS (
            SELECT c.lang, c.k, c.phrase, c.n AS a, cut, l.n AS l, r.n AS r,
                   (2000000::HUGEINT * c.n) // (l.n::HUGEINT + r.n) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
            JOIN f l ON l.lang = c.lang AND l.phrase = list_aggregate(w[1 : cut], 'string_agg', ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = list_aggregate(w[cut + 1 : c.k], 'string_agg', ' ')),
        lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (
            SELECT DISTINCT x.lang, x.part AS phrase FROM (
                SELECT lang, n, unnest(flatten(list_transform(range(2, k), lambda m:
                    list_transform(range(1, k - m + 2), lambda i: list_aggregate(w[i : i + m - 1], 'string_agg', ' '))))) AS part
                FROM candidates) x
            JOIN f ON f.lang = x.lang AND f.phrase = x.part AND 100 * x.n::HUGEINT >= 80 * f.n::HUGEINT)
        SELECT s.lang, row_number() OVER by_score AS rank, s.phrase, s.a, s.l, s.r, total AS n, s.score::BIGINT AS score
        FROM lowest s JOIN total USING (lang) ANTI JOIN inside ON inside.lang = s.lang AND inside.phrase = s.phrase
        WINDOW by_score AS (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase)
        QUALIFY row_number() OVER by_score <= 2000
    """,
}
