"""The clause grammar against its definition, and what is learned on held-out rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import queries, toxicity, transducers as t
from footfall.llm.tables import table


def by_definition(symbols):
    """Flags of heavy words, word by word: what each transducer says it does."""
    flags, covered, said, quoted = [], 0, False, False
    for s in symbols:
        heavy = s in (t.INSULT, t.THREAT)
        flags.append(((t.NEGATED if covered else 0) | (t.REPORTED if said or quoted else 0)) if heavy else 0)
        if s == t.NOT:
            covered = 3
        elif s != t.QUOTE:
            covered = max(0, covered - 1)
        if s == t.SAYS and not quoted:
            said = True
        elif s == t.QUOTE and quoted:
            said = quoted = False
        elif s == t.QUOTE and said:
            said, quoted = False, True
    return flags, t.AIMED if t.TARGET in symbols else 0


def test_composed_grammar_equals_its_parts():
    grammar = t.clause_grammar()
    for n in range(6):
        for symbols in itertools.product(t.SYMBOLS, repeat=n):
            assert grammar.read(symbols) == by_definition(symbols)


def test_beginnings_find_words():
    trie = t.Beginnings({"trash$": 1, "tra": 2, "éco": 3})
    text = "trash trashes xtrash tra! école (tra"
    assert trie.find(text) == {0: 1, 6: 2, 21: 2, 26: 3, 33: 2}
    assert t.Beginnings({}).find(text) == {}


READ = [
    ("that fool was here", "direct"), ("You fool!", "aimed"), ("you are not a fool", "negated"),
    ("not now, fool", "direct"), ("She said he is a fool", "reported"), ("she said no. fool", "direct"),
    ('he calls them "fool" and leaves', "reported"), ("I will kill you", "threat"), ("FOOLS, FOOL", "direct"),
]


@pytest.mark.parametrize("text, where", READ)
def test_outcomes(text, where):
    _, sums = toxicity.Grammar({"fool": 2.0}).read(text)
    assert sums[toxicity.OUTCOMES.index(where)] > 0
    assert sum(x > 0 for x in sums) == 1


def test_plain_use_of_a_threat_word_is_none():
    assert toxicity.Grammar({}).read("they said it would kill time")[1] == [0.0] * 5
    assert toxicity.Grammar({}).read("it does not kill you")[1] == [0.0] * 5


def test_newton_finds_the_optimum():
    rng = np.random.default_rng(2)
    x = np.c_[np.ones(400), rng.normal(size=(400, 7))]
    y = (rng.random(400) < 1 / (1 + np.exp(-x @ np.arange(-3, 5)))).astype(float)
    beta = toxicity.fit(x, y)
    p = 1 / (1 + np.exp(-x @ beta))
    assert np.abs(x.T @ (y - p) - (beta - toxicity.PRIOR)).max() < 1e-6


def out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def made(docs):
    """Texts of 60 words; toxic ones hold inflected words of two stems."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{rng.choice('abcdefgh')}{rng.choice('klmn')}" for _ in range(60)]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            words[rng.randrange(60)] = rng.choice(["zork", "blug"]) + rng.choice(["a", "ene", "isch", ""])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_rows_are_not_learned_from(spark, docs, made):
    rows, labels = made
    ask = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")
    wrong = ask.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(docs(*rows), x).orderBy("doc_id").collect() for x in (ask, wrong))
    assert a == b
    assert [r.held_out for r in a] == [out(r.doc_id) for r in a]
    assert [r.predicted for r in a] == [x for _, x in labels]


def test_odd_rows_and_inputs(spark, docs, made, odd):
    rows, labels = made
    ask = spark.createDataFrame([*labels, (7, None), (None, 1), (3, 0)], "doc_id BIGINT, toxic INT")
    columns = ("doc_id", "held_out", "score", "predicted")
    extra = [(None, "zorka zork blugene"), (None, None), (900, ""), (901, "zork " * 50_000), (0, rows[0][1]), (0, rows[0][1])]
    got = toxicity.score(docs(*rows, *extra), ask).select(*columns).collect()
    assert len(got) == len(rows) + len(extra)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[0]) == 3 and len(set(by[0])) == 1
    assert by[901][0].predicted == 1 and by[900][0].predicted == 0
    assert {r.held_out for r in by[None]} == {True} and len(by[None]) == 2
    assert all(0 <= r.score <= 1 and r.score is not None for r in got)
    # without labels of both kinds
    for none in (ask.limit(0), ask.where("toxic = 1"), ask.where("toxic = 0")):
        assert toxicity.score(docs((1, "zork"), (2, None)), none).count() == 2
    assert toxicity.score(odd, ask).count() == odd.count()
    assert toxicity.score(docs((1, "a")).limit(0), ask).count() == 0


def test_score_ignores_everything_but_the_text(spark, docs, made):
    rows, labels = made
    ask = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")
    df = docs(*rows)
    insults, beta = toxicity.learn(df, ask)
    texts = df.select(F.lit(1).alias("doc_id"), "text").mapInArrow(
        toxicity._read(insults, beta), f"doc_id INT, {toxicity._COUNTS}, score DOUBLE")
    want = sorted(round(r.score, 9) for r in texts.collect())
    assert sorted(r.score for r in toxicity.score(df, ask).collect()) == want


def test_training_rows_are_bounded(spark):
    ask = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    n = toxicity.training_ids(ask, 1000).count()
    assert 850 < n < 1150
    assert toxicity.training_ids(ask, 1000).where(toxicity.held_out()).isEmpty()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op11_toxicity(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id")
    r = found.selectExpr(
        "avg(predicted) FILTER (WHERE toxic = 1) AS caught", "avg(predicted) FILTER (WHERE toxic = 0) AS wrong").first()
    assert r.caught >= 0.9 and r.wrong <= 0.01
