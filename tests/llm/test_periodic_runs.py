"""Periodic runs against a word by word version."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from footfall.llm import periodic_runs, queries
from footfall.llm.tables import table
from tests.conftest import SF


def brute(words):
    """All runs by following every diagonal; the smallest period is checked by definition."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(24, 3 * q):
                part = words[start:j]
                if not any(all(part[k] == part[k - d] for k in range(d, length)) for d in range(1, q)):
                    out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, plant):
    words = (text or "").encode().split()
    if plant and doc_id is not None:
        words = planted(doc_id, words)
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *four, sha(listed.encode()), sha(kept))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def odd_words(seed):
    """Words with runs side by side, nested and overlapping, over few letters."""
    rng = random.Random(seed)
    out = []
    for _ in range(rng.randint(1, 6)):
        unit = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 9, 16, 17, 31, 40]))]
        if rng.random() < 0.4:
            unit = unit + unit[: rng.randint(1, len(unit))] + [rng.choice("abcd")]
        times = rng.choice([1, 2, 3, 4, 9])
        out += (unit * times)[: rng.randint(1, len(unit) * times)]
        out += [rng.choice("abcxyz") for _ in range(rng.choice([0, 0, 1, 3]))]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    texts = [odd_words(seed * 100 + i) for i in range(60)]
    names = {w: np.uint64(periodic_runs.mix(np.array([ord(w)], np.uint64))[0]) for w in "abcdxyz"}
    digests = np.array([names[w] for t in texts for w in t], np.uint64)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = periodic_runs.find_runs(digests, at)
    for k, t in enumerate(texts):
        assert found.get(k, []) == brute(t), t


def test_a_period_whose_every_part_occurs_twice():
    rng = random.Random(5)
    a, b = ([rng.choice("pq") + str(i) for i in range(40)] for _ in range(2))
    period = a + a + a + b + a + b + b + b
    words = period * 4 + ["end"]
    names = {w: i for i, w in enumerate(sorted(set(words)))}
    digests = periodic_runs.mix(np.array([names[w] + 1 for w in words], np.uint64))
    assert periodic_runs.find_runs(digests, np.array([0, len(words)]))[0] == brute(words)


def test_one_word_many_times_is_linear():
    digests = np.full(300_000, 7, np.uint64)
    assert periodic_runs.find_runs(digests, np.array([0, 300_000])) == {0: [(0, 300_000, 1)]}


@pytest.mark.parametrize("plant", [False, True])
def test_odd_rows(spark, docs, plant):
    texts = [" ".join(odd_words(i)) for i in range(40)] + [None, "", " \n\t ", "a", "é🙂 " * 30, "A a " * 20]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, None)]
    want = sorted((expected(i, t, plant) for i, t in rows), key=repr)
    df = docs(*rows)
    assert got(periodic_runs.run_digests(df, plant)) == want
    full = periodic_runs.collapse_runs(df, plant).selectExpr(
        "doc_id", "size(runs) AS n_runs", "sha2(collapsed, 256) AS collapsed_sha256").collect()
    assert sorted(((r.doc_id, r.n_runs, r.collapsed_sha256) for r in full), key=repr) == sorted(
        ((w[0], w[1], w[7]) for w in want), key=repr)


def test_empty_table(docs):
    assert got(periodic_runs.run_digests(docs((1, "a")).limit(0), True)) == []


def test_registered_query_on_the_small_table(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    short = [r for r in rows if len((r.text or "").split()) <= 700]
    assert len(short) > 50
    want = {r.doc_id: expected(r.doc_id, r.text, True) for r in short}
    result = {r[0]: r for r in got(queries.op13_periodic_runs(spark, SF))}
    assert len(result) == len(rows)
    assert {i: result[i] for i in want} == want
    assert sum(w[1] for w in want.values()) > 5
