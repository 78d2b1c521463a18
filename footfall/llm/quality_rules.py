"""Robust multivariate outliers of document statistics (operator 7).

Every document gets a vector of transformed statistics. Per language and source, the
minimum covariance determinant estimate of centre and scatter is found by concentration
steps: distances to the current estimate, the nearest h = (n + p + 1) / 2 of the n rows, a new
estimate from those. Several fixed starts take some steps each; the one with the lowest
determinant goes on until no step lowers it, so up to half of a group may be junk. The nearest
rows spread less than all do, so their scatter is raised by the factor that makes it right for
normal rows. Last, the estimate is made anew from all rows within a chi-square quantile of it,
which uses nearly every good row. A document is rejected when its squared Mahalanobis distance
to the estimate of its group exceeds `cutoff`.

Statistics are counted inside a row by array functions. Estimation works on a narrow table:
each step is one aggregation by group (combined in the map tasks) and one join of the group
estimates, and the quantile of distances comes from a histogram, so no group meets in one
task. The inverse is applied by a Cholesky solution written in column arithmetic.
"""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from footfall.llm.tables import SPACE, digest, hand_over, light, text_or_empty

#: The vector's members and the least spread that counts in each. A statistic that is
#: nearly constant in a group, such as symbols in clean prose, would otherwise make any
#: other value an outlier. Shares reach 1 (`x_lines`) and, within the base rule, the root of
#: a half (`x_repeats`); with these floors either passes CUTOFF alone.
FLOORS = {
    "x_length": 0.5,
    "x_word": 0.10,
    "x_symbols": 0.05,
    "x_lines": 0.215,
    "x_repeats": 0.155,
}
NAMES = tuple(FLOORS)
SIZE = len(NAMES)


def chi_square(x: float, degrees: int) -> float:
    """Probability that a chi-square variable of `degrees` is at most x."""
    at, below = (1, math.erf(math.sqrt(x / 2))) if degrees % 2 else (2, 1 - math.exp(-x / 2))
    while at < degrees:
        below -= (x / 2) ** (at / 2) * math.exp(-x / 2) / math.gamma(at / 2 + 1)
        at += 2
    return below


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def consistency(support: float) -> float:
    """What the scatter of the nearest `support` of normal rows is multiplied by."""
    if support >= 1:
        return 1.0
    return support / chi_square(chi_square_quantile(support, SIZE), SIZE + 2)


#: Squared distance that one of a thousand normal rows exceeds.
CUTOFF = chi_square_quantile(0.999, SIZE)

#: Rows within this quantile of the concentrated estimate make the final one.
NEAR_SHARE = 0.975
NEAR = chi_square_quantile(NEAR_SHARE, SIZE)

#: An estimate belongs to a group and to the start it came from.
KEY = ("stratum", "start")

#: Histogram of distances: cells per factor of two, cells in all.
CELLS_PER_DOUBLING, CELLS = 16, 1024

#: Files of a table with one row per group.
FEW = 8

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are compared by 64-bit digests. Texts without a repeated window, found by one
    pass over a hash set, skip the sort. Of sorted (digest, place) pairs those with an equal
    neighbour are marked; every marked window adds the words the one before did not cover.
    """
    places = F.sequence(F.lit(1), F.size(words) - 2)
    digests = F.transform(
        places,
        lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)),
    )

    def covered(d: Column) -> Column:
        pairs = F.array_sort(F.transform(d, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(p: Column) -> Column:
            hit = F.filter(
                p,
                lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]),
            )
            return F.array_sort(F.transform(hit, lambda x: x["i"]))

        def add(state: Column, i: Column) -> Column:
            fresh = F.least(F.lit(3), i - state["last"])
            return F.struct((state["n"] + fresh).alias("n"), i.alias("last"))

        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        total = lambda m: F.aggregate(m, start, add, lambda s: s["n"])
        return _let(pairs, lambda p: _let(marked(p), total))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        _let(digests, lambda d: F.when(F.size(F.array_distinct(d)) == F.size(d), F.lit(0)).otherwise(covered(d)))
    )


def _let(value: Column, use) -> Column:
    """Bind a costly array once for an expression that names it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def statistics(docs: DataFrame, carry=()) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text; null text has none."""
    text = text_or_empty()
    rows = docs.select(
        *carry,
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    return rows.select(
        *carry, "doc_id", "lang", "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        _repeat_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
    )


def _vector(df: DataFrame) -> DataFrame:
    """Transformed statistics; defined for every row, a text without words included."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return df.withColumns({
        "x_length": F.log1p(F.col("n_words").cast("double")),
        "x_word": F.log1p(F.col("word_chars") / words),
        "x_symbols": F.sqrt(F.col("n_symbols") / words),
        "x_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / words),
    })


def _moments(rows: DataFrame, support: float) -> DataFrame:
    """Per stratum and start: means, scatter with the floors as its Cholesky factor, log
    determinant. The scatter is that of the nearest `support` of normal rows."""
    raised = consistency(support)
    sums = [F.sum(n).alias("s_" + n) for n in NAMES]
    cross = [
        F.sum(F.col(a) * F.col(b)).alias(f"c_{i}_{j}")
        for i, a in enumerate(NAMES) for j, b in enumerate(NAMES) if j <= i
    ]
    out = rows.groupBy(*KEY).agg(F.count("*").alias("m"), *sums, *cross)
    out = out.withColumns({f"mu_{i}": F.col("s_" + n) / F.col("m") for i, n in enumerate(NAMES)})
    factor: dict[tuple[int, int], Column] = {}
    for i in range(SIZE):
        for j in range(i + 1):
            cov = (F.col(f"c_{i}_{j}") / F.col("m") - F.col(f"mu_{i}") * F.col(f"mu_{j}")) * raised
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + F.lit(FLOORS[NAMES[i]] ** 2)
            rest = cov - sum((factor[i, k] * factor[j, k] for k in range(j)), F.lit(0.0))
            value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / factor[j, j]
            out = out.withColumn(f"f_{i}_{j}", value)
            factor[i, j] = F.col(f"f_{i}_{j}")
    logdet = sum((2 * F.log(factor[i, i]) for i in range(SIZE)), F.lit(0.0))
    keep = [f"mu_{i}" for i in range(SIZE)] + [f"f_{i}_{j}" for i in range(SIZE) for j in range(i + 1)]
    return out.select(*KEY, *keep, logdet.alias("logdet"))


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance of each row to its stratum's estimates, as `d2`, with `start`."""
    own = list(rows.columns)
    joined = rows.join(estimate, "stratum")
    solved: list[Column] = []
    for i, n in enumerate(NAMES):
        done = sum((F.col(f"f_{i}_{k}") * F.col(f"z_{k}") for k in range(i)), F.lit(0.0))
        joined = joined.withColumn(f"z_{i}", (F.col(n) - F.col(f"mu_{i}") - done) / F.col(f"f_{i}_{i}"))
        solved.append(F.col(f"z_{i}"))
    return joined.withColumn("d2", reduce(lambda a, b: a + b, [z * z for z in solved])).select(*own, "start", "d2")


def _nearest(rows: DataFrame, support: float) -> DataFrame:
    """The nearest rows of each stratum and start: `support` of them and (n + p + 1) / 2 at
    least, in whole histogram cells of `d2`."""
    cell = F.least(
        F.greatest((F.log2(F.col("d2") + 1e-9) + 30) * CELLS_PER_DOUBLING, F.lit(0)), F.lit(CELLS - 1)
    ).cast("int")
    rows = rows.withColumn("cell", cell)
    counts = rows.groupBy(*KEY, "cell").agg(F.count("*").alias("n"))  # CELLS a group at most
    by = W.partitionBy(*KEY)
    below = F.sum("n").over(by.orderBy("cell")) - F.col("n")
    need = F.greatest(F.col("total") * support, F.floor((F.col("total") + SIZE + 1) / 2))
    edge = (
        counts.withColumn("below", below).withColumn("total", F.sum("n").over(by))
        .where(F.col("below") < need)
        .groupBy(*KEY).agg(F.max("cell").alias("edge"))
    )
    return rows.join(edge, list(KEY)).where("cell <= edge")


def _started(vectors: DataFrame) -> DataFrame:
    """Every row once per start, with its distance to that start: from the medians in units of
    the floors and of the quartiles' spread, and from the lower and the upper quartiles."""
    points = vectors.groupBy("stratum").agg(
        *[F.percentile_approx(n, [0.25, 0.5, 0.75], 1000).alias("q_" + n) for n in NAMES]
    )
    points = hand_over(points.coalesce(FEW), "quartiles")  # one row per stratum: rows are not dealt by stratum

    def squared(point: int, own_spread: bool) -> Column:
        terms = []
        for n in NAMES:
            spread = F.get("q_" + n, F.lit(2)) - F.get("q_" + n, F.lit(0))
            scale = F.greatest(spread / 1.349, F.lit(FLOORS[n])) if own_spread else F.lit(FLOORS[n])
            terms.append(((F.col(n) - F.get("q_" + n, F.lit(point))) / scale) ** 2)
        return reduce(lambda a, b: a + b, terms)

    starts = [squared(1, False), squared(1, True), squared(0, True), squared(2, True)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("start"), d.alias("d2")) for k, d in enumerate(starts)]))
    rows = vectors.join(points, "stratum").select("stratum", *NAMES, each.alias("at"))
    return rows.select("stratum", *NAMES, "at.start", "at.d2")


def mcd(vectors: DataFrame, support: float = 0.5, trial: int = 2, tolerance: float = 1e-3) -> DataFrame:
    """One estimate per stratum. All starts take `trial` concentration steps. The lowest
    determinant (of equal ones the first start) goes on alone. A stratum settles with the last
    estimate that lowered its log determinant by more than `tolerance`; determinants are bounded
    by the floors, so every stratum settles. Strata that have settled are not read again."""
    def concentrated(rows: DataFrame) -> DataFrame:
        return _moments(_nearest(rows, support), support).coalesce(FEW)

    vectors = vectors.select("stratum", *NAMES)
    estimate = hand_over(concentrated(_started(vectors)), "mcd")
    for _ in range(trial):
        estimate = hand_over(concentrated(_distance(vectors, estimate)), "mcd")
    place = F.row_number().over(W.partitionBy("stratum").orderBy("logdet", "start"))
    active = hand_over(estimate.withColumn("place", place).where("place = 1").drop("place").coalesce(FEW), "mcd")
    settled = []
    while not active.isEmpty():
        before = active.select("stratum", F.col("logdet").alias("before"))
        after = concentrated(_distance(vectors, active)).join(before, "stratum")
        after = hand_over(after.withColumn("lower", F.col("logdet") < F.col("before") - tolerance).coalesce(FEW), "mcd")
        settled.append(active.join(after.where("lower").select("stratum"), "stratum", "left_anti"))
        active = after.where("lower").drop("before", "lower")
    if not settled:
        return estimate
    final = hand_over(reduce(DataFrame.unionByName, settled).coalesce(FEW), "mcd")
    near = _distance(vectors, final).where(F.col("d2") <= NEAR)
    return hand_over(_moments(near, NEAR_SHARE).coalesce(FEW), "mcd")


def judge(
    docs: DataFrame, support: float = 0.5, cutoff: float = CUTOFF, min_rows: int = 100,
    trial: int = 2, tolerance: float = 1e-3, carry=(),
) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed, distance, kept.

    base_failed: under 50 words, or over half of the words in repeated three-word windows.
    Estimates are made from the rows that pass this. Groups of (lang, source) with fewer than
    `min_rows` such rows are pooled by language, and languages that are still too small in one
    common group; null is a language or source of its own. A row whose group has no estimate
    (nothing passed) keeps the base verdict. `carry` names columns to hand through. Null or empty text has no words and fails the
    base rule. Repeated ids are rows of their own; other columns are ignored.
    """
    base = F.col("n_words") < 50
    repeats = F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words")
    rows = hand_over(_vector(statistics(docs, carry)).withColumn("base_failed", base | repeats), "quality")

    passed = rows.where(~F.col("base_failed"))
    key = lambda *c: F.to_json(F.struct(*c))
    small = (
        passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
        .withColumn("pool", F.sum(F.when(F.col("n") < min_rows, F.col("n"))).over(W.partitionBy("lang")))
    )
    strata = hand_over(
        small.select(
            F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
            F.when(F.col("n") >= min_rows, key(F.lit("s").alias("k"), "lang", "source"))
            .when(F.col("pool") >= min_rows, key(F.lit("l").alias("k"), "lang"))
            .otherwise(key(F.lit("all").alias("k"))).alias("stratum"),
        ),
        "strata",
    )
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    vectors = hand_over(passed.join(strata, same).select("doc_id", "stratum", *NAMES), "quality-vectors")
    estimate = mcd(vectors, support, trial, tolerance)

    named = rows.join(strata, same, "left")
    judged = _distance(named.where("stratum IS NOT NULL"), estimate).drop("start")
    rest = named.where("stratum IS NULL").withColumn("d2", F.lit(None).cast("double"))
    far = F.coalesce(F.col("d2") > cutoff, F.lit(False))
    return judged.unionByName(rest).select(
        *carry, "doc_id", "lang", "source", *STATISTICS, "base_failed",
        F.round(F.sqrt("d2"), 6).alias("distance"),
        (~F.col("base_failed") & ~far).alias("kept"),
    )


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns. Rows are found again by id and
    text digest, so repeated ids do not mix; the shorter list of ids is joined."""
    named = docs.withColumn("__digest", digest())
    verdicts = judge(named, carry=["__digest"], **settings).select(
        F.col("doc_id").alias("__id"), F.col("__digest").alias("__d"), "lang", "source", "kept"
    )
    verdicts = hand_over(verdicts, "quality-verdicts")
    counts = verdicts.agg(F.count(F.when(F.col("kept"), 1)).alias("k"), F.count("*").alias("n")).first()
    good = counts.k <= counts.n - counts.k
    side = verdicts.where(F.col("kept") if good else ~F.col("kept"))
    side = light(side.select("__id", "__d", F.col("lang").alias("__l"), F.col("source").alias("__s")).distinct(), min(counts.k, counts.n - counts.k))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & F.col("__digest").eqNullSafe(F.col("__d"))
        & F.col("lang").cast("string").eqNullSafe(F.col("__l")) & F.col("source").cast("string").eqNullSafe(F.col("__s"))
    )
    return named.join(side, same, "left_semi" if good else "left_anti").drop("__digest")
