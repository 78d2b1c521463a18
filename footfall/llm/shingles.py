"""Word shingles of many texts at once, in numpy.

Words are maximal runs of bytes other than blank and tab to carriage return, with A-Z
lowered. A word's digest is a polynomial over a random byte table modulo 2**64, taken from
prefix sums, then mixed; a shingle's digest combines its word digests by place. Everything
runs over flat arrays of one slice of texts, so the cost per byte is a few vector passes.
"""

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; one text at least, long ones in pieces.
SLICE = 1 << 21

_RNG = np.random.default_rng(20_240_131)
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_LOWERED = _TABLE.copy()
_LOWERED[65:91] = _TABLE[97:123]
_BASE = 0x9E3779B97F4A7C15
_PLACES = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next slice."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE + (SLICE >> 3))
        have = np.empty(size, np.uint64)
        have[0], m, p = 1, 1, base % 2**64
        while m < size:
            k = min(m, size - m)
            have[m : m + k] = have[:k] * np.uint64(p)
            m, p = m * 2, p * p % 2**64
        if n <= SLICE + (SLICE >> 3):
            _POWERS[base] = have
    return have[:n]


_INVERSE = pow(_BASE, -1, 2**64)


def prefix_sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of table[byte] * base**place before each place."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def spans_digest(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digests of data[start:end], whatever their place."""
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts])


def slices(column: pa.Array, size: int = SLICE):
    """(first row, bytes, text offsets) over runs of rows of about `size` bytes."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _pieces(data: np.ndarray):
    """Cuts at white space, so that a very long text takes bounded memory."""
    at = 0
    while at < len(data):
        end = at + SLICE
        if end >= len(data):
            end = len(data)
        else:
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            step = end
            while not len(gaps) and step < len(data):  # a word longer than a slice
                nxt = min(step + SLICE, len(data))
                gaps, step = np.flatnonzero(_SPACE[data[step:nxt]]) + (step - at), nxt
            end = at + int(gaps[-1]) + 1 if len(gaps) else len(data)
        yield at, data[at:end]
        at = end


def cut_words(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE, table: np.ndarray = _LOWERED
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests, starts and ends of the words of the texts: maximal runs of bytes outside `gaps`."""
    digests, begins, stops = [], [], []
    cuts = np.zeros(len(data) + 1, bool)
    cuts[offsets] = True  # words do not cross texts
    for at, piece in _pieces(data):
        if not len(piece):
            continue
        inside = ~gaps[piece]
        fresh = cuts[at : at + len(piece)].copy()
        fresh[0] = True
        fresh[1:] |= ~inside[:-1]
        starts = np.flatnonzero(inside & fresh)
        last = np.ones(len(piece), bool)
        last[:-1] = ~inside[1:] | cuts[at + 1 : at + len(piece)]
        ends = np.flatnonzero(inside & last) + 1
        digests.append(spans_digest(prefix_sums(piece, table), starts, ends))
        begins.append(starts + at)
        stops.append(ends + at)
    if not digests:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(digests), np.concatenate(begins), np.concatenate(stops)


def words(data: np.ndarray, offsets: np.ndarray, lowered: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word digests of the texts, and where each text's words begin (one more than texts)."""
    digests, begins, _ = cut_words(data, offsets, table=_LOWERED if lowered else _TABLE)
    return digests, np.searchsorted(begins, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle digests per text: `width` words each, or the whole sequence as
    one where there are fewer; none without words."""
    digests, at = words(data, offsets)
    n = len(digests)
    full = np.zeros(max(0, n - width + 1), np.uint64)
    for i in range(width):
        full += digests[i : i + len(full)] * _PLACES[i]
    full = mix(full)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(full[a : b - width + 1]))
        elif b > a:
            # a number of words that no full shingle has
            terms = [digests[a:b] * _PLACES[: b - a], _PLACES[width + b - a : width + b - a + 1]]
            out.append(mix(np.concatenate(terms).sum(keepdims=True, dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
