"""Difference-cover suffix naming for strings cut to a depth of 200 bytes, in numpy.

Given strings and their numbers of windows, it finds which windows (200 bytes from a place)
occur more than once. As in the three-way difference-cover algorithm, suffixes at places 1 and
2 modulo 3 are the sample. Sampled triples of symbols are sorted and replaced by names, and the
same is done with triples of names, so that a name stands for 8, 24, 72 and then 198 bytes.
Any two suffixes reach sampled places by the same step of 0, 1 or 2: the remaining suffixes
are merged by their first bytes and the name after them. In each merged order, neighbours
whose keys agree share 200 bytes.
"""

import numpy as np

DEPTH = 200


def name(*columns: np.ndarray) -> np.ndarray:
    """Ranks of the rows of some columns of nonnegative numbers in sorted order."""
    rank = columns[0].astype(np.uint64)
    for c in columns[1:]:
        if len(rank) and int(rank.max()).bit_length() + int(c.max()).bit_length() > 64:
            rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
        width = np.uint64(int(c.max()).bit_length() if len(c) else 0)
        rank = (rank << width) | c.astype(np.uint64)
    return np.unique(rank, return_inverse=True)[1].astype(np.uint64)


def _twice(*columns: np.ndarray) -> np.ndarray:
    """Whether a row equals a neighbour in sorted order."""
    names = name(*columns)
    return np.bincount(names.astype(np.int64))[names.astype(np.int64)] > 1 if len(names) else names.astype(bool)


def repeated_windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One flag per place of `data`: a window of DEPTH bytes begins there, inside its string,
    and its bytes begin at another place too."""
    flags = np.zeros(len(data), bool)
    lengths = np.diff(offsets)
    if not len(data):
        return flags
    at = np.arange(len(data))
    place = at - np.repeat(offsets[:-1], lengths)
    room = np.repeat(lengths, lengths) - place  # bytes up to the end of the string
    byte = np.concatenate([data, np.zeros(DEPTH, np.uint8)])

    symbol = np.zeros(len(data), np.uint64)
    for k in range(8):
        symbol = (symbol << np.uint64(8)) | byte[k : k + len(data)]
    names = np.zeros(len(data) + DEPTH, np.uint64)
    names[: len(data)] = name(symbol)

    sampled = place % 3 != 0
    for span, steps in ((24, (0, 8, 16)), (72, (0, 24, 48)), (198, (0, 72, 126))):
        i = at[sampled & (room >= span)]
        named = name(*(names[i + s] for s in steps))
        names = np.zeros_like(names)
        names[i] = named

    window = room >= DEPTH
    # step 0: both sampled; step 1: places 0 and 1; step 2: places 0 and 2
    for step, members in ((0, (1, 2)), (1, (0, 1)), (2, (0, 2))):
        i = at[window & np.isin(place % 3, members)]
        edge = (*range(step), *range(step + 198, DEPTH))
        hit = _twice(names[i + step], *(byte[i + k] for k in edge))
        flags[i[hit]] = True
    return flags
