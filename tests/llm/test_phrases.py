"""Collocations against a counting version in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.llm import phrases
from footfall.llm.phrases import Sizes
from footfall.llm.tables import table
from tests.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = {
            p[i:j] for p, m in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * m >= 80 * counts[p[i:j]]
        }
        scored = []
        for p, a in found.items():
            score, _, l, r = min(
                (2_000_000 * a // (counts[p[:c]] + counts[p[c:]]), c, counts[p[:c]], counts[p[c:]])
                for c in range(1, len(p))
            )
            if p not in dropped:
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    seams = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\r\n", ";x:", "? "]
    vocabulary = ["a", "B", "c", "É", "é", "zz", "the", "The", "x-y", "🙂", "#1"]
    rows = []
    for i in range(160):
        words = [rng.choice(vocabulary[: rng.choice([3, 6, 11])]) for _ in range(rng.randint(0, 40))]
        rows.append(("".join(w + rng.choice(seams) for w in words), rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", None), (" \t ", "de"), rows[0], rows[0]] + [("same words here again", "en")] * 9


SMALL = [Sizes(), Sizes(ranked=4, head=3, tile=2, tiles=2, entries=7), Sizes(ranked=3, head=2, tile=2, tiles=1, entries=1)]


@pytest.mark.parametrize("sizes, least, top", [(SMALL[0], 3, 2000), (SMALL[1], 3, 2000), (SMALL[2], 5, 7)])
def test_collocations_equal_brute_force(spark, odd_rows, sizes, least, top):
    df = spark.createDataFrame(odd_rows, "text STRING, lang STRING").withColumns({"key": F.lit("k"), "u": F.lit(1)})
    assert got(phrases.collocations(df.repartition(5), least, top, sizes=sizes)) == brute(odd_rows, least, top)


@pytest.mark.parametrize("sizes", SMALL[:2])
def test_given_table(spark, sizes):
    docs = table(spark, SF, "documents")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    assert got(phrases.collocations(docs, sizes=sizes)) == brute(rows, 30, 2000)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text STRING, lang STRING")
    assert got(phrases.collocations(none)) == []
    rare = spark.createDataFrame([("one two three", "en"), (None, None)], "text STRING, lang STRING")
    assert got(phrases.collocations(rare)) == []


def test_a_phrase_across_slices_and_long_texts(spark, monkeypatch):
    long = "alpha beta gamma. " * 150_000  # more than a slice
    df = spark.createDataFrame([(long, "en")], "text STRING, lang STRING")
    assert got(phrases.collocations(df)) == [("en", 1, "alpha beta gamma", 150_000, 150_000, 150_000, 450_000, 1_000_000)]
