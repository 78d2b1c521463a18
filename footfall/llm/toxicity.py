"""Toxicity by a weighted finite-state grammar of clauses (operator 11).

Insults are learned from labels as beginnings of words, since inflected languages vary the
ends: the beginnings that toxic texts use more often than clean ones, by a likelihood ratio
test, each with the log ratio of its rates as weight. Threats, people meant, negations and words
of saying are fixed lists. A text is cut into clauses; the composed grammar (`transducers`)
reads each clause with an insult or a threat and tells whether it is negated, reported, or aimed
at someone. Clauses, not words, are scored: their weights are summed by outcome, and a logistic
regression on these sums, learned from the same rows, gives the score.

Only labelled rows outside the held-out fifth are learned from, at most about `train_rows` of
them, dealt by a hash of the id. The list of these ids is the only thing that is broadcast.
Everything else is one pass over all texts, each read whole; nothing of it is shuffled.
"""

import math
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm import transducers as t
from footfall.llm.tables import hand_over, text_or_empty

# Words of the grammar in English, German, French and Spanish.
TARGETS = """you your yours yourself u they them their he him she her
du dich dir dein deine ihr euch euer tu te toi ton ta vous votre tú ti usted ustedes vosotros""".split()
NEGATIONS = """not no never none nobody without isn't aren't wasn't don't doesn't didn't won't can't
nicht kein keine keinen nie niemals ohne ne pas jamais aucun aucune sans nunca jamás ningún ninguna sin""".split()
SAYINGS = """said says say saying told tells called calls claimed claims wrote writes quoted quotes reported
sagte sagt sagen nannte nennt behauptet behauptete schrieb dit disait disent appelle appelait écrit
dijo dice dicen llamó llama escribió""".split()
THREATS = """kill killing hurt destroy shoot stab strangle murder töten umbringen erschießen ermorden
tuer frapper détruire assassiner matar golpear destruir asesinar""".split()

WORD = re.compile(r"[^\W\d_]+")
#: Words with an apostrophe inside are one symbol of a clause.
SYMBOL = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”„«»]")
CLAUSE_END = re.compile(r"[.,;:!?\n\r]")
_CONTEXT = {
    **dict.fromkeys(TARGETS, t.TARGET), **dict.fromkeys(NEGATIONS, t.NOT), **dict.fromkeys(SAYINGS, t.SAYS),
    **dict.fromkeys("\"“”„«»", t.QUOTE),
}

#: Letters of the beginnings that are tried.
SHORTEST, LONGEST = 3, 10

#: Outcomes of a clause whose weights are summed.
OUTCOMES = ("direct", "aimed", "negated", "reported", "threat")
FEATURES = ("one", "clauses", "aimed", "negated", "reported", "threat", "length", "density")
#: What the regression is drawn to where labels say nothing: a bias against toxic, reported and
#: negated clauses worth nothing.
PRIOR = np.array([-3.0, 1.0, 0.5, 0.0, 0.0, 1.0, 0.0, 0.5])


def held_out(doc_id="doc_id") -> Column:
    """The fifth that nothing is learned from; a null id belongs to it."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def training_ids(labels: DataFrame, train_rows: int) -> DataFrame:
    """(doc_id, toxic) of labelled rows outside the held-out fifth: all, or the share with the
    smallest hashes that makes about `train_rows`. An id labelled twice is toxic if any label is."""
    ids = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = ids.count()
    if total > train_rows:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * train_rows // total)
    return hand_over(ids, "toxic-ids")


def beginnings(word: str):
    for k in range(SHORTEST, min(LONGEST, len(word)) + 1):
        yield word[:k]
    if len(word) <= LONGEST:
        yield word + "$"


def _count_beginnings(candidates: frozenset[str] | None):
    """(stem, docs, hits) over the texts of a task; the empty stem has their texts and words."""

    def run(batches):
        docs, hits = Counter(), Counter()

        def out():
            stems = list(docs)
            return pa.record_batch(
                [pa.array(stems, pa.string()), pa.array([docs[s] for s in stems], pa.int64()), pa.array([hits[s] for s in stems], pa.int64())],
                names=["stem", "docs", "hits"],
            )

        for batch in batches:
            for text in batch.column("text"):
                found = Counter(WORD.findall(text.as_py().lower()))
                docs[""] += 1
                hits[""] += sum(found.values())
                own = Counter()
                for word, n in found.items():
                    for stem in beginnings(word):
                        if candidates is None or stem in candidates:
                            own[stem] += n
                docs.update(own.keys())
                hits.update(own)
                if len(docs) > 500_000:
                    yield out()
                    docs, hits = Counter(), Counter()
        if docs:
            yield out()

    return run


def _counted(texts: DataFrame, candidates=None) -> DataFrame:
    rows = texts.select("text").mapInArrow(_count_beginnings(candidates), "stem STRING, docs BIGINT, hits BIGINT")
    return rows.groupBy("stem").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits"))


def learn_insults(
    train: DataFrame, min_docs: int = 5, min_share: float = 0.005, evidence: float = 30.0, ratio: float = 4.0,
) -> dict[str, float]:
    """Weight by beginning, from rows (text, toxic).

    Candidates occur in `min_share` of the toxic texts, which bounds their number by the
    distinct beginnings of 1 / min_share texts. Those stay whose likelihood ratio
    statistic over texts reaches `evidence` and whose rate in toxic texts is `ratio` times that in
    clean ones. Of nested ones that with the most evidence comes first; longer ones then add
    nothing, and shorter ones count for the words it leaves."""
    toxic = hand_over(_counted(train.where("toxic = 1")), "toxic-stems")
    size = toxic.where("stem = ''").select("docs", "hits").first()
    if size is None:
        return {}
    enough = toxic.where((F.col("docs") >= max(min_docs, math.ceil(min_share * size.docs))) & (F.col("stem") != ""))
    candidates = frozenset(enough.select("stem").toArrow().column("stem").to_pylist())
    clean = hand_over(_counted(train.where("toxic = 0"), candidates), "clean-stems")
    other = clean.where("stem = ''").select("docs", "hits").first()
    if other is None or not candidates:
        return {}
    both = enough.join(clean.select("stem", F.col("docs").alias("c_docs"), F.col("hits").alias("c_hits")), "stem", "left")
    a, b = F.col("docs").cast("double"), F.coalesce("c_docs", F.lit(0)).cast("double")
    share = (a + b) / (size.docs + other.docs)

    def term(x, of, p):  # x log(x / expected)
        return F.when(x > 0, x * F.log(x / (of * p))).otherwise(0.0)

    statistic = 2 * (
        term(a, F.lit(size.docs), share) + term(size.docs - a, F.lit(size.docs), 1 - share)
        + term(b, F.lit(other.docs), share) + term(other.docs - b, F.lit(other.docs), 1 - share)
    )
    seen, missed = F.col("hits"), F.coalesce("c_hits", F.lit(0))

    def weight(t_hits: float, c_hits: float) -> float:
        return math.log((t_hits + 0.5) / size.hits) - math.log((c_hits + 0.5) / other.hits)

    kept = both.select("stem", statistic.alias("g"), seen.alias("t"), missed.alias("c")).where(F.col("g") >= evidence)
    chosen: dict[str, tuple[int, int]] = {}
    found = [(-round(r.g, 6), -len(r.stem), r.stem, r.t, r.c) for r in kept.collect() if weight(r.t, r.c) >= math.log(ratio)]
    for _, _, stem, t_hits, c_hits in sorted(found):
        plain = stem.removesuffix("$")
        if any(plain.startswith(c) for c in chosen if not c.endswith("$")) or plain + "$" in chosen:
            continue
        # what longer beginnings with more evidence leave of this one
        inner = [n for c, n in chosen.items() if c.startswith(plain)] if plain == stem else []
        t_hits, c_hits = t_hits - sum(n[0] for n in inner), c_hits - sum(n[1] for n in inner)
        if t_hits >= min_docs and weight(t_hits, c_hits) >= math.log(ratio) / 2:
            chosen[stem] = (t_hits, c_hits)
    return {stem: weight(*n) for stem, n in chosen.items()}


class Grammar:
    """Reads texts: insults by weight, the fixed words, and the composed clause transducer."""

    def __init__(self, insults: dict[str, float]):
        self.words = t.Beginnings({**{w + "$": None for w in THREATS}, **insults})  # None: a threat
        self.clauses = t.clause_grammar()

    def read(self, text: str) -> tuple[int, list[float]]:
        """Words of a text, and the weight of its clauses by outcome."""
        low = text.lower()
        sums = [0.0] * len(OUTCOMES)
        found = self.words.find(low)
        if found:
            ends = [m.start() for m in CLAUSE_END.finditer(low)]
            clauses: dict[int, list[int]] = {}
            for place in found:
                clauses.setdefault(bisect_right(ends, place), []).append(place)
            for k in clauses:
                a, b = ends[k - 1] + 1 if k else 0, ends[k] if k < len(ends) else len(low)
                self._clause(low, a, b, found, sums)
        return len(low.split()), sums

    def _clause(self, low: str, a: int, b: int, found, sums) -> None:
        symbols, weights = [], []
        for m in SYMBOL.finditer(low, a, b):
            weight = found.get(m.start(), 0.0)
            if m.start() in found:
                symbols.append(t.THREAT if weight is None else t.INSULT)
            else:
                symbols.append(_CONTEXT.get(m.group(), t.OTHER))
            weights.append(weight)
        flags, clause = self.clauses.read(symbols)
        for symbol, flag, weight in zip(symbols, flags, weights):
            if symbol == t.THREAT:
                if clause & t.AIMED and not flag:
                    sums[4] += 1.0
            elif symbol == t.INSULT:
                where = 2 if flag & t.NEGATED else 3 if flag & t.REPORTED else 1 if clause & t.AIMED else 0
                sums[where] += weight


def features(n_words: np.ndarray, sums: np.ndarray) -> np.ndarray:
    clauses = sums[:, 0] + sums[:, 1]
    return np.stack(
        [
            np.ones(len(n_words)), np.log1p(clauses), np.log1p(sums[:, 1]), np.log1p(sums[:, 2]), np.log1p(sums[:, 3]),
            np.log1p(sums[:, 4]), np.log1p(n_words), np.log1p(100 * clauses / (n_words + 10)),
        ],
        axis=1,
    )


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Logistic regression drawn to PRIOR, by Newton steps that are halved until they help."""

    def loss(beta):
        z = x @ beta
        return (np.logaddexp(0, z) - y * z).sum() + ridge / 2 * ((beta - PRIOR) ** 2).sum()

    beta = PRIOR.copy()
    at = loss(beta)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (y - p) - ridge * (beta - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        move = np.linalg.solve(curve, slope)
        while (after := loss(beta + move)) > at and np.abs(move).max() > 1e-12:
            move = move / 2
        if after > at or np.abs(move).max() < 1e-10:
            break
        beta, at = beta + move, after
    return beta


def _read(insults: dict[str, float], beta: np.ndarray | None):
    """Counts and sums of each row, and its score where the regression is known."""

    def run(batches):
        grammar = Grammar(insults)
        for batch in batches:
            got = [grammar.read(x.as_py()) for x in batch.column("text")]
            n = np.array([w for w, _ in got], np.int64)
            sums = np.array([s for _, s in got], np.float64).reshape(-1, len(OUTCOMES))
            columns = [c for c in batch.schema.names if c != "text"]
            out = [batch.column(c) for c in columns] + [pa.array(n), *(pa.array(sums[:, i]) for i in range(len(OUTCOMES)))]
            names = [*columns, "n_words", *OUTCOMES]
            if beta is not None:
                z = np.clip(features(n, sums) @ beta, -500, 500)
                out.append(pa.array(1 / (1 + np.exp(-z))))
                names.append("score")
            yield pa.record_batch(out, names=names)

    return run


_COUNTS = "n_words BIGINT, " + ", ".join(f"{o} DOUBLE" for o in OUTCOMES)


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = 50_000) -> tuple[dict[str, float], np.ndarray]:
    """(weights of insulting beginnings, coefficients) from the labelled rows of `docs`."""
    ids = training_ids(labels, train_rows)
    # about train_rows narrow rows at most, whatever the input
    train = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).join(
        F.broadcast(ids), "doc_id"
    )
    insults = learn_insults(train)
    rows = train.select("toxic", "text").mapInArrow(_read(insults, None), f"toxic INT, {_COUNTS}")
    # repeated ids give a row each; counts of equal rows keep the list short
    counted = rows.groupBy("toxic", "n_words", *OUTCOMES).agg(F.count("*").alias("times")).toArrow()
    x = features(counted.column("n_words").to_numpy(), np.stack([counted.column(o).to_numpy() for o in OUTCOMES], 1))
    y, times = counted.column("toxic").to_numpy().astype(float), counted.column("times").to_numpy()
    if not len(y):
        return insults, PRIOR
    order = np.lexsort((*x.T, y))
    return insults, fit(np.repeat(x[order], times[order], 0), np.repeat(y[order], times[order]))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = 50_000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_words and the weight of its
    clauses by outcome (direct, aimed, negated, reported, threat).

    Null and empty texts have no clause and get the score of a text without words. Null ids are
    held out; repeated ids are rows of their own. Labels without an id or a verdict count as
    none; without labels of both kinds nothing is known to insult, and only the fixed threats and
    the prior score. An empty table gives an empty result. Language, source and id are no inputs,
    and other columns are ignored.
    """
    insults, beta = learn(docs, labels, train_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    read = rows.mapInArrow(_read(insults, beta), f"doc_id BIGINT, {_COUNTS}, score DOUBLE")
    return read.select(
        "doc_id", held_out().alias("held_out"), F.round("score", 9).alias("score"),
        (F.round("score", 9) >= 0.5).cast("int").alias("predicted"), "n_words",
        *[F.round(o, 6).alias(o) for o in OUTCOMES],
    )
