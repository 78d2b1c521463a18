"""Cutting text into parts that a byte-level BPE encodes on their own.

The split pattern of the vocabulary never matches across the start of a white space run
that follows other text, so a text may be cut there and each part encoded alone. Parts
repeat a lot, which makes them good cache keys.
"""

import re

#: Blank or line feed runs with the text up to the next one.
_PARTS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space other than blank and line feed; cuts next to it would not be safe.
_OTHER_SPACE = re.compile(r"[^\S \n]")


def parts(text: str) -> list[str]:
    """The text in parts that join to it. With unusual white space it is one part."""
    if _OTHER_SPACE.search(text):
        return _safe_parts(text)
    return _PARTS.findall(text)


def _safe_parts(text: str) -> list[str]:
    """Cuts before a blank or line feed between two characters that are no white space
    (one blank, or a run of plain blanks and line feeds) only."""
    out, start = [], 0
    for m in _RUN.finditer(text):
        if m.start() > start:
            out.append(text[start : m.start()])
            start = m.start()
    out.append(text[start:])
    return out


#: A run of blanks and line feeds that no other white space touches.
_RUN = re.compile(r"(?<=\S)[ \n]+(?=\S)")


class PartCache:
    """Part -> value, for at most two generations of `size` parts.

    When the young generation is full it becomes the old one; parts in use move back. It only
    saves work: a part that was forgotten is computed again.
    """

    def __init__(self, compute, size: int = 400_000, longest: int = 200):
        self.compute, self.size, self.longest = compute, size, longest
        self.young: dict = {}
        self.old: dict = {}

    def values(self, keys: list[str]) -> list:
        """Values in the order of the keys; `compute` gets the distinct misses as a list."""
        young = self.young
        try:
            return [young[k] for k in keys]
        except KeyError:
            pass
        missing = [k for k in dict.fromkeys(keys) if k not in young]
        fresh, extra = [], {}
        for k in missing:
            if (v := self.old.get(k)) is not None:
                young[k] = v
            else:
                fresh.append(k)
        for k, v in zip(fresh, self.compute(fresh) if fresh else ()):
            if len(k) <= self.longest:
                young[k] = v
            else:
                extra[k] = v
        out = [young[k] if k in young else extra[k] for k in keys]
        if len(young) > self.size:
            self.old, self.young = young, {}
        return out
