"""Collocations of two to four words by direct-address tiling (operator 12).

Words are counted by language first. Those that occur `least` times are ranked by frequency,
since no frequent phrase holds a rarer word. Then every task counts the adjacent pairs of its
texts: pairs of two words of the highest ranks fall into square tiles of the (rank, rank) plane,
dense arrays that `bincount` adds to by direct address; all other pairs are sorted coordinate
lists with counts. Both are combined inside the task and passed on by pair, so a pair that is
everywhere costs each task one row.

Frequent pairs are tokens of the next level. They are ranked anew, texts become sequences of
them, and two adjacent pairs, which share a word, are a phrase of three; two adjacent threes
are a phrase of four. Every level is one pass over the texts by the same code.

A token's key is a 64-bit digest: of a word's bytes, or of the keys of the two tokens it is
made of. Tables are joined by it. Tasks know at most `ranked` tokens of a level; where more
are frequent, tokens outside are not sifted before counting and all go to the sparse lists,
so results are the same and only the shuffle grows.

What a phrase needs is carried from level to level with its counts: those of its beginnings
and of its ends, so cuts cost no further join. A phrase lies inside a longer one only if it
begins or ends one that is a word longer and at least as frequent, so that level decides.
"""

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from footfall.llm.shingles import cut_words, mix, slices
from footfall.llm.tables import hand_over, text_or_empty

#: Language of rows without one.
NO_LANG = "und"

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NO_RANK = np.int64(2**40)

_BREAKS = np.zeros(256, bool)
_BREAKS[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
_GAPS = _BREAKS.copy()
_GAPS[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Sizes:
    """What a task holds. Results do not depend on it."""

    #: Tokens of a level that tasks know by rank.
    ranked: int = 1_000_000
    #: Ranks that are counted in dense tiles, and the side of a tile.
    head: int = 1024
    tile: int = 512
    #: Tiles, and entries of the sparse lists, before a task passes counts on.
    tiles: int = 64
    entries: int = 600_000
    #: Bytes of text that are worked on at a time.
    slice: int = 1 << 20


@dataclass(frozen=True)
class Level:
    """Tokens that tasks know, by language: sorted keys, their ranks, keys by rank."""

    known: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]
    complete: bool  # all frequent tokens are among them

    def ranks(self, lang: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of tokens (_NO_RANK for unknown ones), and which may be frequent."""
        ranks = np.full(len(keys), _NO_RANK)
        if lang in self.known and len(keys):
            have, rank, _ = self.known[lang]
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            hit = have[at] == keys
            ranks[hit] = rank[at[hit]]
        return ranks, ranks < _NO_RANK if self.complete else np.ones(len(keys), bool)


def pair_keys(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(u * _LEFT + mix(v * _RIGHT))


def _texts(batches):
    """(language, texts) over runs of rows of one language."""
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for lang in pc.unique(langs).to_pylist():
            yield lang, texts.filter(pc.equal(langs, lang))


def _words(data: np.ndarray, offsets: np.ndarray):
    """Keys, starts and ends of the words of a slice, and which follow the word before them
    in the same piece."""
    keys, starts, ends = cut_words(data, offsets, _GAPS)
    piece = np.searchsorted(np.flatnonzero(_BREAKS[data]), starts)
    text = np.searchsorted(offsets, starts, side="right")
    follows = np.zeros(len(keys), bool)
    follows[1:] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return keys, starts, ends, follows


class _Sparse:
    """Counts by key with further columns, sorted by key."""

    def __init__(self):
        self.rows, self.new, self.size, self.pending = None, [], 0, 0

    def add(self, keys, *columns):
        if len(keys):
            self.new.append((keys, np.ones(len(keys), np.int64), *columns))
            self.size += len(keys)
            self.pending += len(keys)
            if self.pending > max(1 << 18, self.size // 2):
                self.combined()

    def combined(self):
        parts = ([self.rows] if self.rows is not None else []) + self.new
        if self.new:
            keys, counts, *columns = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            at = order[first]
            self.rows = (keys[first], np.add.reduceat(counts[order], first), *(c[at] for c in columns))
            self.new, self.size, self.pending = [], len(first), 0
        return self.rows


class _Tiles:
    """Dense counts of (rank, rank), allocated where a pair occurs."""

    def __init__(self, sizes: Sizes):
        self.side, self.across = sizes.tile, -(-sizes.head // sizes.tile)
        self.held: dict[int, np.ndarray] = {}
        self.added = 0

    def add(self, u, v):
        self.added += len(u)
        tile = (u // self.side) * self.across + v // self.side
        order = np.argsort(tile, kind="stable")
        cell = ((u % self.side) * self.side + v % self.side)[order]
        tile = tile[order]
        cuts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]])) if len(tile) else []
        for a, b in zip(cuts, cuts[1:]):
            counts = np.bincount(cell[a:b], minlength=self.side**2).astype(np.int32)
            t = int(tile[a])
            if t in self.held:
                self.held[t] += counts
            else:
                self.held[t] = counts

    def counts(self):
        """(rank, rank, count) of the pairs that occurred."""
        for t, counts in self.held.items():
            cell = np.flatnonzero(counts)
            row, column = divmod(t, self.across)
            yield row * self.side + cell // self.side, column * self.side + cell % self.side, counts[cell].astype(np.int64)


def _count_words(sizes: Sizes):
    """(lang, key, word, n) of a task's texts."""

    def run(batches):
        held: dict[str, tuple[_Sparse, dict[int, bytes]]] = {}

        def out():
            for lang, (counts, names) in held.items():
                keys, n = counts.combined()
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                        pa.array([names[k] for k in keys.tolist()], pa.binary()).cast(pa.string()), pa.array(n),
                    ],
                    names=["lang", "key", "word", "n"],
                )
            held.clear()

        for lang, texts in _texts(batches):
            for _, data, offsets in slices(texts, sizes.slice):
                keys, starts, ends, _ = _words(data, offsets)
                if not len(keys):
                    continue
                counts, names = held.setdefault(lang, (_Sparse(), {}))
                raw = data.tobytes().translate(_LOWER)
                found, at = np.unique(keys, return_index=True)
                for k, a, b in zip(found.tolist(), starts[at].tolist(), ends[at].tolist()):
                    if k not in names:
                        names[k] = raw[a:b]
                counts.add(keys)
                if sum(s.size for s, _ in held.values()) > sizes.entries // 2:
                    yield from out()
        yield from out()

    return run


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _count_pairs(levels: list[Level], sizes: Sizes):
    """(lang, u, v, n) of the adjacent tokens of the last level, u and v being their keys."""
    last = levels[-1]

    def run(batches):
        held: dict[str, tuple[_Tiles, _Sparse]] = {}

        def rows(lang, u, v, n):
            return pa.record_batch(
                [pa.array([lang] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(n)],
                names=["lang", "u", "v", "n"],
            )

        def out():
            for lang, (tiles, sparse) in held.items():
                for u, v, n in tiles.counts():
                    by_rank = last.known[lang][2]
                    yield rows(lang, by_rank[u], by_rank[v], n)
                if sparse.combined() is not None:
                    _, n, u, v = sparse.combined()
                    yield rows(lang, u, v, n)
            held.clear()

        for lang, texts in _texts(batches):
            for _, data, offsets in slices(texts, sizes.slice):
                keys, _, _, follows = _words(data, offsets)
                for level in levels:
                    ranks, live = level.ranks(lang, keys)
                    left = np.flatnonzero(follows[1:] & live[1:] & live[:-1])
                    u, v = keys[left], keys[left + 1]
                    if level is not last:  # adjacent tokens are the tokens of the next level
                        keys = pair_keys(u, v)
                        follows = np.zeros(len(left), bool)
                        follows[1:] = left[1:] == left[:-1] + 1
                if not len(left):
                    continue
                tiles, sparse = held.setdefault(lang, (_Tiles(sizes), _Sparse()))
                a, b = ranks[left], ranks[left + 1]
                dense = (a < sizes.head) & (b < sizes.head)
                tiles.add(a[dense], b[dense])
                u, v = u[~dense], v[~dense]
                sparse.add(pair_keys(u, v), u, v)
                if (
                    sum(len(t.held) for t, _ in held.values()) > sizes.tiles
                    or tiles.added > 1 << 30  # cells have 32 bits
                    or sum(s.size for _, s in held.values()) > sizes.entries
                ):
                    yield from out()
        yield from out()

    return run


def _level(frequent: DataFrame, sizes: Sizes) -> Level:
    """The most frequent tokens of (lang, key, n) for the tasks: at most about `ranked`."""
    total = frequent.count()
    some = frequent
    if total > sizes.ranked:
        above = frequent.agg(F.percentile_approx("n", 1 - sizes.ranked / total, 10_000)).first()[0]
        some = frequent.where(F.col("n") > above)
    found = some.select("lang", "key", "n").toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    keys = found.column("key").to_numpy().view(np.uint64)
    n = found.column("n").to_numpy()
    known = {}
    for lang in set(langs.tolist()):
        own = np.flatnonzero(langs == lang)
        by_rank = keys[own[np.lexsort((keys[own], -n[own]))]]
        order = np.argsort(by_rank)
        known[lang] = (by_rank[order], order.astype(np.int64), by_rank)
    return Level(known, len(keys) == total)


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = 4, sizes: Sizes = Sizes()) -> tuple[DataFrame, list[DataFrame]]:
    """(words of every language with counts, the frequent phrases of each length from 2 on).

    Words: lang, key, word, n. Phrases: lang, key, phrase, n, heads, tails, u, v; `heads` are the
    counts of the first 1, 2, ... words, `tails` of the last ones."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_or_empty().alias("text")
    )
    words = hand_over(
        texts.mapInArrow(_count_words(sizes), "lang STRING, key BIGINT, word STRING, n BIGINT")
        .groupBy("lang", "key", "word").agg(F.sum("n").alias("n")),
        "phrase-words",
    )
    frequent = words.where(F.col("n") >= least)
    parts = frequent.select(
        "lang", "key", F.col("word").alias("phrase"), F.col("word").alias("ending"), "n",
        F.array().cast("array<bigint>").alias("heads"), F.array().cast("array<bigint>").alias("tails"),
    )
    levels, out = [], []
    for length in range(2, longest + 1):
        levels.append(_level(parts, sizes))
        pairs = (
            texts.mapInArrow(_count_pairs(list(levels), sizes), "lang STRING, u BIGINT, v BIGINT, n BIGINT")
            .groupBy("lang", "u", "v").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            .mapInArrow(_with_key, "lang STRING, u BIGINT, v BIGINT, n BIGINT, key BIGINT")
        )
        left = parts.select("lang", F.col("key").alias("u"), F.col("phrase").alias("begin"), "heads", F.col("n").alias("head"))
        right = parts.select("lang", F.col("key").alias("v"), "ending", "tails", F.col("n").alias("tail"))
        parts = hand_over(
            pairs.join(left, ["lang", "u"]).join(right, ["lang", "v"]).select(
                "lang", "key", F.concat_ws(" ", "begin", "ending").alias("phrase"), "ending", "n",
                F.array_append("heads", F.col("head")).alias("heads"),
                F.array_append("tails", F.col("tail")).alias("tails"), "u", "v",
            ),
            "phrases",
        )
        out.append(parts)
    return words, out


def _with_key(batches):
    for batch in batches:
        u, v = (batch.column(c).to_numpy().view(np.uint64) for c in ("u", "v"))
        yield pa.record_batch([*batch.columns, pa.array(pair_keys(u, v).view(np.int64))], names=[*batch.schema.names, "key"])


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, longest: int = 4, percent: int = 80, sizes: Sizes = Sizes()
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are cut into pieces at `.,;:!?` and line ends, pieces into words at blanks and tabs, A-Z
    is lowered. Phrases have 2 to `longest` words and occur a >= `least` times inside pieces. Cut
    in two, with l and r occurrences of its parts, a phrase scores floor(2,000,000 a / (l + r)); the
    lowest cut counts, at ties the shortest beginning. A phrase is dropped if a longer one with
    the same words inside has at least `percent` percent of its count. Order: score and count
    descending, then the phrase by its UTF-8 bytes.

    Null and empty texts have no words; a null language is `und`. Repeated rows and ids count
    each time; other columns are ignored; an empty table gives an empty result, and so does a
    language without a frequent phrase.
    """
    words, lengths = phrase_counts(docs, least, longest, sizes)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    judged = []
    for i, phrases in enumerate(lengths):
        own = phrases.select("lang", "key", "phrase", "n", "heads", "tails")
        if i + 1 < len(lengths):
            longer = lengths[i + 1]
            around = reduce(
                DataFrame.unionByName, [longer.select("lang", F.col(c).alias("key"), F.col("n").alias("m")) for c in "uv"]
            ).groupBy("lang", "key").agg(F.max("m").alias("m"))
            inside = 100 * F.col("m").cast("decimal(30,0)") >= percent * F.col("n").cast("decimal(30,0)")
            own = own.join(around.where("m IS NOT NULL"), ["lang", "key"], "left").where(~F.coalesce(inside, F.lit(False)))
        judged.append(own.select("lang", "phrase", "n", "heads", "tails"))
    every = reduce(DataFrame.unionByName, judged)

    cut = F.expr("""
        array_min(transform(sequence(1, size(heads)), c -> struct(
            CAST(n AS DECIMAL(30,0)) * 2000000 div (CAST(heads[c - 1] AS DECIMAL(30,0)) + tails[size(tails) - c]) AS score,
            c AS c, heads[c - 1] AS l, tails[size(tails) - c] AS r)))
    """)
    scored = every.select("lang", "phrase", F.col("n").alias("a"), cut.alias("cut"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("total").alias("n"), F.col("cut.score").cast("bigint").alias("score"),
    )
