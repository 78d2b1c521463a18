"""Fast similarity sketching (Dahlgaard, Knudsen, Thorup 2017) in numpy.

A sketch has t coordinates, filled in up to 2t rounds. In round i < t every element goes to a
bin chosen by that round's hash; in round t + j every element goes to bin j, so each
coordinate is filled for sure. A coordinate keeps the smallest (round, hash) that reached it.
Rounds stop once all bins are filled; for a set of at least t log t elements that is one or
two rounds. Equal coordinates estimate the Jaccard similarity without bias, and as an element
takes few bins per round they concentrate as with independent minima or better.
"""

import numpy as np

from footfall.llm.shingles import mix

_EMPTY = np.uint64(2**64 - 1)
_STEP = 0xD1342543DE82EF95


def _salt(i: int) -> np.uint64:
    return np.uint64((i + 1) * _STEP % 2**64)


def sketch(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of `size` coordinates per non-empty set; rows of empty sets stay unfilled."""
    table = np.full((len(sets), size), _EMPTY)
    flat = table.reshape(-1)
    active = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if not len(active):
        return table
    elements = np.concatenate([sets[i] for i in active])
    owner = np.repeat(active, [len(sets[i]) for i in active])
    for i in range(2 * size):
        h = mix(elements ^ _salt(i))
        if i < size:
            bins = ((h >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        else:
            bins = i - size
        # the round above 46 bits of an independent hash
        value = (np.uint64(i) << np.uint64(46)) | (mix(h) >> np.uint64(18))
        np.minimum.at(flat, owner * size + bins, value)
        open_rows = active[(table[active] == _EMPTY).any(axis=1)]
        if not len(open_rows):
            break
        if len(open_rows) < len(active):
            still = np.zeros(len(sets), bool)
            still[open_rows] = True
            keep = still[owner]
            elements, owner, active = elements[keep], owner[keep], open_rows
    return table


def bands(table: np.ndarray, rows: int) -> np.ndarray:
    """One digest per band of `rows` coordinates; the band's number is part of it."""
    count = table.shape[1] // rows
    out = np.empty((len(table), count), np.uint64)
    for b in range(count):
        h = np.full(len(table), _salt(b))
        for r in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + table[:, b * rows + r])
        out[:, b] = h
    return out
