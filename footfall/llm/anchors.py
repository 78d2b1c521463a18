"""Content-defined anchors: where a repeat of `LENGTH` bytes can begin, in numpy.

The windows of `LENGTH` bytes of a text are dealt to anchors: a window belongs to the place
inside it whose `GRAM`-byte string has the smallest digest (the leftmost one of equals). That
depends on the window's bytes only, so equal windows belong to anchors with equal strings, at
the same distance. About one place in 70 is an anchor, and each owns a run of windows.
"""

import numpy as np

from footfall.llm.shingles import mix, powers, prefix_sums, slices, spans_digest

LENGTH = 200
GRAM = 64
#: Places that a window's anchor is chosen from.
CHOICES = LENGTH - GRAM + 1
#: Bytes worked on at a time; places fit the low bits of a compared number.
PIECE, PLACE_BITS = 1 << 20, np.uint64(21)

_RNG = np.random.default_rng(77_003)
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 2**64)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def window_anchors(data: np.ndarray):
    """Of one text's bytes: anchor digests and places, first window and number of windows each anchor
    owns, and digests of all bytes those windows cover."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    sums = prefix_sums(data, _TABLE)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(_INVERSE, len(sums))[: len(data) - GRAM + 1])
    ranked = (grams & ~np.uint64((1 << 21) - 1)) | np.arange(len(grams), dtype=np.uint64)
    own = (_sliding_min(ranked, CHOICES) & np.uint64((1 << 21) - 1)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
    count = np.diff(np.concatenate([first, [len(own)]]))
    place = own[first]
    # the place inside the run is part of the digest: equal bytes, but another distance, differ
    covered = spans_digest(sums, first, first + count - 1 + LENGTH)
    covered = mix(covered ^ ((place - first).astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64))
    return grams[place], place, first, count, covered


def text_anchors(column):
    """(row, anchor digest, its place, first window, windows, covered digest) over the texts of a column.
    Longer texts go piece by piece; a run that a piece cuts has another covered digest, which
    only costs a closer look later."""
    for row, data, offsets in slices(column, PIECE):
        rows, found = [], []
        for i in range(len(offsets) - 1):
            text = data[offsets[i] : offsets[i + 1]]
            for at in range(0, max(1, len(text) - LENGTH + 1), PIECE):
                digests, place, first, count, covered = window_anchors(text[at : at + PIECE + LENGTH - 1])
                found.append((digests, place + at, first + at, count, covered))
                rows.append(np.full(len(first), row + i, np.int64))
        yield np.concatenate(rows), *(np.concatenate(x) for x in zip(*found))
