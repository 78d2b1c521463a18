"""Soft-membership mixing (operator 5).

A classifier learned from the labelled table gives each document posterior probabilities of
three domains: clean, low_quality, toxic. A document of n tokens then stands for n * p_k
tokens of domain k, and nonnegative rates r (expected copies) are fitted so that the summed
expected tokens match the targets: minimise |sum_d n_d r_d p_d - T|^2 by projected gradient
steps from r = 1. In the inner product weighted by n_d the gradient of a document is
p_d . residual, so a step needs nothing but the k totals of the step before. They are one
aggregation each; rates are folded again from the list of past steps, so no step rewrites
the table. Steps are scaled by the inverse of the k x k matrix of posterior products, and
fall back to the plain gradient where that does not bring the totals nearer.

The classifier is a linear discriminant over a few text statistics and the weights of a
lexicon. It is fitted on a bounded sample of labelled rows (`sample_rows`); the lexicon has
`lexicon_size` words. Scores, totals and rates cover every document.
"""

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.tables import SPACE, hand_over, light, text_or_empty

DOMAINS = ("clean", "low_quality", "toxic")
TARGETS = {"clean": 0.90, "low_quality": 0.08, "toxic": 0.02}
FEATURES = ("f_length", "f_symbols", "f_upper", "f_distinct", "f_word", "f_toxic", "f_toxic_share")


@dataclass(frozen=True)
class Classifier:
    """Words with their weights, and one linear score per domain."""

    lexicon: dict[str, float]
    weights: list[list[float]] = field(default_factory=list)  # per domain: bias, then features


def _words() -> Column:
    return F.filter(F.split(F.lower(text_or_empty()), f"[{SPACE}]+"), lambda w: w != "")


def features(docs: DataFrame, lexicon: dict[str, float], keep=()) -> DataFrame:
    """Numbers that the classifier sees, for every whole text."""
    known = F.array(*[F.lit(w) for w in lexicon]) if lexicon else F.array().cast("array<string>")
    weight = F.create_map(*[x for w, v in lexicon.items() for x in (F.lit(w), F.lit(float(v)))]) if lexicon else None
    text = text_or_empty()
    rows = docs.select(
        *keep,
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text).alias("chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>!]")).alias("symbols"),
        F.regexp_count(text, F.lit(r"[A-Z]")).alias("upper"),
        _words().alias("words"),
    ).withColumn("n_tokens", F.size("words").cast("bigint"))
    rows = rows.withColumn("vocabulary", F.array_distinct("words")).drop("words")
    rows = rows.withColumn("hits", F.array_intersect("vocabulary", known))
    total = F.aggregate("hits", F.lit(0.0), lambda s, w: s + F.element_at(weight, w)) if lexicon else F.lit(0.0)
    n = F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("chars"), F.lit(1)).cast("double")
    return rows.select(
        *keep, "doc_id", "n_tokens",
        F.log1p(F.col("n_tokens").cast("double")).alias("f_length"),
        F.least(F.col("symbols") / n, F.lit(3.0)).alias("f_symbols"),
        (F.col("upper") / chars).alias("f_upper"),
        (F.size("vocabulary") / n).alias("f_distinct"),
        F.least(F.col("chars") / n, F.lit(30.0)).alias("f_word"),
        F.log1p(total).alias("f_toxic"),
        F.sqrt(F.size("hits") / n).alias("f_toxic_share"),
    )


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most about `rows` labelled documents, chosen by a hash of the id, with `domain`."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("__id"), domain.alias("domain")
    )
    share = min(1.0, rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(1_000_000 * share)).distinct()
    return docs.join(known, docs["doc_id"].cast("bigint") == known["__id"]).select("doc_id", "text", "domain")


def _lexicon(sample: DataFrame, size: int, support: int) -> dict[str, float]:
    """Words whose documents are toxic far more often than others, with their log odds."""
    totals = sample.agg(F.count("*").alias("n"), F.count(F.when(F.col("domain") == 2, 1)).alias("t")).first()
    if not totals.t or totals.t == totals.n:
        return {}
    words = sample.select(F.explode(F.array_distinct(_words())).alias("word"), (F.col("domain") == 2).alias("toxic"))
    counts = words.groupBy("word").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("toxic"), 1)).alias("t")
    ).where(F.col("t") >= support)
    odds = F.log((F.col("t") + 0.5) / (totals.t + 1.0)) - F.log((F.col("n") - F.col("t") + 0.5) / (totals.n - totals.t + 1.0))
    best = counts.withColumn("odds", odds).where("odds > 2").orderBy(F.desc(F.col("odds") * F.sqrt("t")), "word")
    return {r["word"]: float(r["odds"]) for r in best.limit(size).collect()}


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, lexicon_size: int = 256, support: int = 5,
) -> Classifier:
    """Linear discriminant with a common covariance, from per-domain sums.

    Without any usable label every document is clean with probability one. A domain that
    the sample lacks has probability zero.
    """
    sample = hand_over(_sample(docs, labels, sample_rows), "mix-sample")
    lexicon = _lexicon(sample, lexicon_size, support)
    rows = features(sample, lexicon, keep=("domain",))
    sums = [F.sum(f).alias("s_" + f) for f in FEATURES]
    cross = [F.sum(F.col(a) * F.col(b)).alias(f"c_{a}_{b}") for i, a in enumerate(FEATURES) for b in FEATURES[: i + 1]]
    found = {r["domain"]: r for r in rows.groupBy("domain").agg(F.count("*").alias("n"), *sums, *cross).collect()}
    if not found:
        return Classifier({}, [[0.0] + [0.0] * len(FEATURES)] + [[-math.inf] + [0.0] * len(FEATURES)] * 2)
    size, total = len(FEATURES), sum(r["n"] for r in found.values())
    means, cov = {}, np.zeros((size, size))
    for k, r in found.items():
        means[k] = np.array([r["s_" + f] / r["n"] for f in FEATURES])
        for i, a in enumerate(FEATURES):
            for j, b in enumerate(FEATURES[: i + 1]):
                cov[i, j] += r[f"c_{a}_{b}"] - r["n"] * means[k][i] * means[k][j]
    cov = np.tril(cov) + np.tril(cov, -1).T
    cov = cov / total + np.diag(1e-4 + 1e-3 * np.diag(cov) / total)
    weights = []
    for k in range(len(DOMAINS)):
        if k in found:
            w = np.linalg.solve(cov, means[k])
            bias = math.log(found[k]["n"] / total) - 0.5 * float(w @ means[k])
            weights.append([bias, *map(float, w)])
        else:
            weights.append([-math.inf] + [0.0] * size)
    return Classifier(lexicon, weights)


def posteriors(docs: DataFrame, model: Classifier, keep=()) -> DataFrame:
    """doc_id, n_tokens and p_<domain>, which sum to one."""
    rows = features(docs, model.lexicon, keep)
    scores = []
    for bias, *w in model.weights:
        if bias == -math.inf:
            scores.append(F.lit(-1e9))
        else:
            scores.append(sum((F.lit(v) * F.col(f) for v, f in zip(w, FEATURES)), F.lit(bias)))
    rows = rows.withColumns({f"e_{k}": s for k, s in zip(DOMAINS, scores)})
    top = F.greatest(*[F.col(f"e_{k}") for k in DOMAINS])
    rows = rows.withColumn("top", top)
    rows = rows.withColumns({f"e_{k}": F.exp(F.col(f"e_{k}") - F.col("top")) for k in DOMAINS})
    total = sum((F.col(f"e_{k}") for k in DOMAINS), F.lit(0.0))
    return rows.select(*keep, "doc_id", "n_tokens", *[(F.col(f"e_{k}") / total).alias(f"p_{k}") for k in DOMAINS])


def _rate(steps: list[list[float]]) -> Column:
    """Rates after the given gradient steps, each projected to zero or more."""
    if not steps:
        return F.lit(1.0)
    past = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    p = [F.col(f"p_{k}") for k in DOMAINS]

    def step(r: Column, g: Column) -> Column:
        move = sum((p[i] * F.get(g, F.lit(i)) for i in range(len(p))), F.lit(0.0))
        return F.greatest(F.lit(0.0), r - move)

    return F.aggregate(past, F.lit(1.0), step)


def fit_rates(scored: DataFrame, weights: dict[str, float], budget: float, steps: int, tolerance: float) -> tuple[list[list[float]], list[float]]:
    """Gradient steps (as lists of k numbers) and the relative residuals they end with."""
    pairs = [(a, b) for i, a in enumerate(DOMAINS) for b in DOMAINS[: i + 1]]
    first = scored.agg(
        F.sum("n_tokens").alias("n"),
        *[F.sum(F.col("n_tokens") * F.col(f"p_{a}") * F.col(f"p_{b}")).alias(f"g_{a}_{b}") for a, b in pairs],
    ).first()
    total = float(first["n"] or 0)
    if total <= 0:
        return [], [0.0] * len(DOMAINS)
    gram = np.zeros((len(DOMAINS), len(DOMAINS)))
    for a, b in pairs:
        i, j = DOMAINS.index(a), DOMAINS.index(b)
        gram[i, j] = gram[j, i] = float(first[f"g_{a}_{b}"]) / total
    share = sum(weights.values())
    target = [budget * weights.get(k, 0.0) / share for k in DOMAINS]

    def residual(past: list[list[float]]) -> np.ndarray:
        sums = scored.withColumn("r", _rate(past)).agg(
            *[F.sum(F.col("n_tokens") * F.col("r") * F.col(f"p_{k}")).alias(k) for k in DOMAINS]
        ).first()
        return np.array([float(sums[k]) / total - t for k, t in zip(DOMAINS, target)])

    # the scaled step is exact while no rate is held at zero; the plain one always descends
    trace = max(float(np.trace(gram)), 1e-9)
    scaled = np.linalg.inv(gram + 1e-6 * trace * np.eye(len(DOMAINS)))
    plain = np.eye(len(DOMAINS)) / max(float(np.linalg.eigvalsh(gram)[-1]), 1e-9)
    past: list[list[float]] = []
    rest = residual(past)
    while len(past) < steps and np.abs(rest).max() >= tolerance:
        for scale in (scaled, plain):
            trial = [*past, [float(x) for x in scale @ rest]]
            after = residual(trial)
            if np.linalg.norm(after) < 0.999 * np.linalg.norm(rest):
                past, rest = trial, after
                break
        else:
            break  # neither step gets nearer: the targets cannot be met better
    return past, [float(x) for x in rest]


def mix(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None,
    budget: float = 1.0,
    sample_rows: int = 20_000, steps: int = 60, tolerance: float = 2e-3, keep=(),
) -> DataFrame:
    """One row per document: doc_id, n_tokens, p_<domain>, rate, copies.

    Targets are shares (`weights`) of `budget` times the tokens that the input has. `copies` rounds the rate up or down
    by a hash of the id, so that its expectation is the rate and repeats give the same. Texts
    without words have no tokens, cost nothing and stay at the rate of their posteriors. Null
    ids round alike. Empty tables give an empty result; without labels all is clean. If a
    target cannot be met, the rates are those with the least squared distance found.
    """
    model = fit(docs, labels, sample_rows)
    scored = hand_over(posteriors(docs, model, keep), "mix-posteriors")
    past, _ = fit_rates(scored, weights or TARGETS, budget, steps, tolerance)
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.lit(1_000_000)) / 1_000_000.0
    rated = scored.withColumn("rate", _rate(past))
    return rated.select(
        *keep, "doc_id", "n_tokens", *[F.round(f"p_{k}", 9).alias(f"p_{k}") for k in DOMAINS],
        F.round("rate", 9).alias("rate"),
        F.floor(F.col("rate") + draw).cast("bigint").alias("copies"),
    )


def copies_of(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """The rows of `docs`, each as often as its `copies` say, with all their columns. Most have
    one; only the others' ids are joined, with a digest of the text, so rows that repeat an id, or
    have none, get what their own text is given."""
    taken = {c.lower() for c in docs.columns}
    kind = next(n for n in (f"__text{i}" for i in range(99)) if n not in taken)
    named = docs.withColumn(kind, F.xxhash64(text_or_empty()))
    plan = mix(named, labels, weights, budget=budget, keep=[kind])
    other = plan.where("copies <> 1").select(F.col("doc_id").alias("o_id"), F.col(kind).alias("o_text"), F.col("copies").alias("o_copies")).distinct()
    other = hand_over(other, "mix-copies")
    same = F.col("r.doc_id").cast("bigint").eqNullSafe(F.col("o.o_id")) & (F.col(f"r.{kind}") == F.col("o.o_text"))
    joined = named.alias("r").join(light(other, other.count()).alias("o"), same, "left")
    times = F.coalesce("o.o_copies", F.lit(1)).cast("int")
    return joined.withColumn("__n", F.explode(F.array_repeat(F.lit(1), times))).select(*[F.col(f"r.{c}") for c in docs.columns])
