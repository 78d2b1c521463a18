"""Periodic runs of words by an online sparse diagonal DP (operator 13).

A run is a stretch of words with smallest period q and at least max(24, 3q) words that no
neighbour extends. On the diagonal "word i against word i - q" it is a match of at least
max(24 - q, 2q) words, which is never less than 16.

The DP goes through the words of a text once. A word's earlier occurrence at distance q adds
one to the match length of diagonal q if that diagonal was active at the word before, and
opens it otherwise; a diagonal that is not continued ends, and emits its run at once if it is
long enough. What makes it sparse is which occurrences count: those that agree in `context`
words from there on, and of these only the nearest. No run is lost by that:

- Periods up to 16 use a context of 16 words, periods in (16, 32] one of 32, and so on by
  doubling. A run of such a period matches in more words than the context has, so each of its
  context strings occurs again one period later.
- The context is at least as long as the period. Were there an equal string nearer than q
  inside the run, the words between would have both periods, hence their greatest common
  divisor (Fine and Wilf), and q would not be the smallest. So the nearest occurrence lies at q.
- For the same reason a diagonal of nearest occurrences has q as its smallest period, and the
  words before and after it break the period.

A word has one nearest occurrence, so a text of n words costs O(n) steps a context, however
often a word is repeated; words whose context occurs once are no step at all. Contexts are
compared by 64-bit digests, made for a slice of texts at a time by array operations.
"""

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.shingles import mix, slices, words
from footfall.llm.tables import text_or_empty

#: Words of the shortest context; every run matches in as many words on its diagonal.
CONTEXT = 16
#: Least length of a run: in words, and in periods.
WORDS, PERIODS = 24, 3

_LEFT, _RIGHT, _TEXT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def diagonals(steps: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(first word, last word, lag) of the diagonals in (word, lag) steps by ascending word."""
    active: dict[int, list[int]] = {}
    for word, lag in steps:
        seen = active.get(lag)
        if seen is not None and seen[1] == word - 1:
            seen[1] = word
        else:
            if seen is not None:
                yield seen[0], seen[1], lag
            active[lag] = [word, word]
    for lag, (first, last) in active.items():
        yield first, last, lag


def _nearest(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ascending places with keys: the distance to the nearest earlier place with the same
    key (0 where there is none), and whether the key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    lags = np.zeros(len(keys), np.int64)
    lags[order[1:][same]] = (places[order][1:] - places[order][:-1])[same]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return lags, again


def find_runs(digests: np.ndarray, at: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) by text, sorted; `at` tells where each text's words begin.
    Texts without a run are left out."""
    lengths = np.diff(at)
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(at[1:], lengths)
    places = np.arange(len(digests))
    grams = mix(digests ^ mix(text.astype(np.uint64) * _TEXT))  # equal in one text only
    width = 1
    runs: dict[int, list[tuple[int, int, int]]] = {}

    def doubled(grams, width):
        after = np.zeros(len(grams), np.uint64)
        after[: max(0, len(grams) - width)] = grams[width:]
        return mix(grams * _LEFT + mix(after * _RIGHT))

    while width < CONTEXT:
        grams, width = doubled(grams, width), 2 * width
    live = places[places + width <= ends]
    while len(live):
        lags, again = _nearest(grams[live], live)
        near = (lags > (0 if width == CONTEXT else width // 2)) & (lags <= width)
        for first, last, lag in diagonals(zip(live[near].tolist(), lags[near].tolist())):
            start, length = first - lag, last + width - first + lag
            if length >= max(WORDS, PERIODS * lag):
                k = int(text[first])
                runs.setdefault(k, []).append((start - int(at[k]), length, lag))
        live = live[again]
        live = live[live + 2 * width <= ends[live]]
        if len(live):
            grams, width = doubled(grams, width), 2 * width
    return {k: sorted(found, key=lambda r: (r[0], r[2])) for k, found in runs.items()}


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place when the row is made periodic by the checksum of its id;
    None where it stays as it is (a null id always does)."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def strongest(runs):
    """The run of greatest exact length / period; ties go to the smallest start, then period."""
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapsed(words: list[bytes], runs) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _texts(batches, plant: bool):
    """(id, words, runs) of each row, a slice of rows at a time."""
    for batch in batches:
        column, ids = batch.column("text").cast(pa.large_string()), batch.column("doc_id")
        for row, data, offsets in slices(column):
            digests, at = words(data, offsets, lowered=False)
            raw, cuts = data.tobytes(), offsets.tolist()
            names = ids.slice(row, len(cuts) - 1).to_pylist()
            orders = {}
            if plant:
                for k, (doc_id, n) in enumerate(zip(names, np.diff(at).tolist())):
                    order = planted_order(doc_id, n)
                    if order is not None:
                        orders[k] = order
                        digests[at[k] : at[k + 1]] = digests[at[k] : at[k + 1]][order]
            runs = find_runs(digests, at)
            yield names, (
                ([own[i] for i in orders[k].tolist()] if k in orders else own, runs.get(k, []))
                for k, own in enumerate(raw[a:b].split() for a, b in zip(cuts, cuts[1:]))
            )


def _digests(plant: bool):
    def run(batches):
        for names, texts in _texts(batches, plant):
            rows = []
            for doc_id, (own, runs) in zip(names, texts):
                best = strongest(runs)
                start, length, period = best or (None, None, None)
                listed = "".join("%d,%d,%d\n" % r for r in runs).encode()
                rows.append((
                    doc_id, len(own), len(runs), start, length, period, 1000 * length // period if best else None,
                    hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(own, runs))).hexdigest(),
                ))
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                names=["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli",
                       "runs_sha256", "collapsed_sha256"],
            )

    return run


def _full(plant: bool):
    def run(batches):
        for names, texts in _texts(batches, plant):
            for doc_id, (own, runs) in zip(names, texts):  # a row at a time: texts are long
                yield pa.record_batch(
                    [
                        pa.array([doc_id], pa.int64()), pa.array([len(own)], pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs]], pa.list_(_RUN)),
                        pa.array([b" ".join(collapsed(own, runs)).decode("utf-8")], pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))


def collapse_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period), and `collapsed`, its
    words joined by one blank without those that any run holds after its first period.

    Nulls and cases as in `run_digests`."""
    return _rows(docs).mapInArrow(
        _full(plant), "doc_id BIGINT, n_words BIGINT, "
        "runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed STRING",
    )


def run_digests(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_runs, the strongest run (start, length, period,
    exponent_milli; nulls without a run), and digests of all runs and of the collapsed text.

    `plant` first makes the rows periodic whose id's checksum says so (`planted_order`), as a
    check of the operator on prose. Null and empty texts, and texts of white space, have no
    words and no run, and the digests of the empty string. A null id is kept and never planted.
    Repeated rows are rows of their own; other columns are ignored; an empty table gives an
    empty result. Nothing is shuffled.
    """
    return _rows(docs).mapInArrow(
        _digests(plant),
        "doc_id BIGINT, n_words BIGINT, n_runs BIGINT, start BIGINT, length BIGINT, period BIGINT, "
        "exponent_milli BIGINT, runs_sha256 STRING, collapsed_sha256 STRING",
    )
