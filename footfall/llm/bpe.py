"""Byte-level BPE by a segment tree over adjacent pair ranks (operator 8).

A part of the text becomes a row of symbols, one per byte. Leaf i of the tree holds the merge
rank of symbol i with its right neighbour; an inner node holds the smallest of its `FAN` children,
the leftmost one when they are equal. The root is then the leftmost pair of lowest rank. A merge
changes the leaves of the new symbol, of its left neighbour and of the symbol that vanished,
each in logarithmic time, until the root holds no mergeable pair.

Merges are read from the vocabulary file. Texts are cut into words by the split pattern, and
the results of repeated words are kept; rows are independent, so the work is one pass
over Arrow batches without a shuffle.
"""

import hashlib
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from footfall.llm.tables import text_or_empty, tokenizer_path

#: Words that a generation of a worker's memory holds, the longest of them, and the characters
#: that a generation's words and their ids have in all.
KNOWN_WORDS, LONGEST, KNOWN_CHARS = 150_000, 200, 8_000_000

#: Words whose ids are turned back at a time.
AT_ONCE = 10_000

#: No pair to merge; ranks are smaller. Children of a node: most words need no inner node.
NONE, FAN = 1 << 60, 16

#: Split pattern of byte-level BPE files; a fixed value of the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [rest.get(b) or chr(b) for b in range(256)]


class Words(dict):
    """Coded words, made when first asked for. `older` words that are asked for again move over;
    the rest of them is forgotten with the next generation, and made again if need be."""

    def __init__(self, make):
        self.make, self.older, self.chars = make, {}, 0

    def __missing__(self, word: str) -> str:
        value = self.older.get(word) or self.make(word)
        if len(word) <= LONGEST:
            if len(self) >= KNOWN_WORDS or self.chars >= KNOWN_CHARS:
                self.older, self.chars = dict(self), 0
                self.clear()
            self[word] = value
            self.chars += len(word) + len(value)
        return value


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        letters = byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.byte_ids = [vocab[c] for c in letters]
        # pair of ids -> (rank, id of the merged symbol)
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        back = {c: b for b, c in enumerate(letters)}
        # by the id as a decimal
        self.bytes_of = {str(i): bytes(back[c] for c in s) for s, i in vocab.items()}
        self.special = {t["content"]: str(t["id"]) for t in spec.get("added_tokens") or []}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        longest = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.known = Words(self.word)
        self.specials = regex.compile("|".join(longest)) if longest else None

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one word, by the tree."""
        n = len(data)
        ids = [self.byte_ids[b] for b in data]
        if n < 2:
            return ids
        find = self.pairs.get
        right = list(range(1, n + 1))  # neighbours among the symbols that are left
        left = list(range(-1, n - 1))
        leaves = [NONE] * n  # rank * n + place: ties go to the left by themselves
        merged = [0] * n  # what the pair at a place becomes
        for i in range(n - 1):
            pair = find((ids[i], ids[i + 1]))
            if pair is not None:
                leaves[i] = pair[0] * n + i
                merged[i] = pair[1]
        steps, top = [], leaves  # each row of nodes with the one above; the root is the least of the last
        while len(top) > FAN:
            above = [min(top[k : k + FAN]) for k in range(0, len(top), FAN)]
            steps.append((top, above))
            top = above

        while (low := min(top)) != NONE:
            i = low % n
            j = right[i]
            ids[i] = merged[i]
            after = right[i] = right[j]
            if after < n:
                left[after] = i
            # the symbol that vanished, the new one, and its left neighbour
            for place in (j, i, left[i]):
                if place < 0:
                    continue
                value, beside = NONE, right[place]
                if place != j and beside < n:
                    pair = find((ids[place], ids[beside]))
                    if pair is not None:
                        value = pair[0] * n + place
                        merged[place] = pair[1]
                if leaves[place] == value:
                    continue
                leaves[place] = value
                k = place
                for below, above in steps:
                    k //= FAN
                    low = min(below[k * FAN : k * FAN + FAN])
                    if above[k] == low:
                        break  # nothing changes above
                    above[k] = low
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = right[i]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special strings become their own id."""
        return [int(i) for told in self.pieces(text) for i in told.split(",")]

    def coded(self, text: str) -> list[str]:
        """The coded words of a text without special strings."""
        return list(map(self.known.__getitem__, self.words.findall(text)))

    def word(self, word: str) -> str:
        """Ids of one word, as decimals joined by commas."""
        return ",".join(map(str, self.merge(word.encode("utf-8"))))

    def decode(self, ids) -> str:
        return self.text([",".join(map(str, ids))] if len(ids) else [])

    def text(self, pieces: list[str]) -> str:
        """The text of coded words. They are taken apart some at a time: ids as strings of their own
        need several times the space of the text."""
        find, parts = self.bytes_of.__getitem__, []
        for k in range(0, len(pieces), AT_ONCE):
            parts.append(b"".join(map(find, ",".join(pieces[k : k + AT_ONCE]).split(","))))
        return b"".join(parts).decode("utf-8", "replace")

    def pieces(self, text: str) -> list[str]:
        """The coded words and special strings of a text, in order."""
        if self.specials is None or not self.specials.search(text):
            return self.coded(text)
        out, start = [], 0
        for m in self.specials.finditer(text):
            out += self.coded(text[start : m.start()])
            out.append(self.special[m[0]])
            start = m.end()
        return out + self.coded(text[start:])


_CODECS: dict[str, Codec] = {}


def _codec(name: str) -> Codec:
    """One codec per Python worker, with the words it knows."""
    if name not in _CODECS:
        _CODECS[name] = Codec(tokenizer_path(name))
    return _CODECS[name]


def _round_trip(name: str):
    def run(batches):
        codec = _codec(name)
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for text in batch.column("text").to_pylist():
                found = codec.pieces(text)
                told = ",".join(found).encode("ascii")
                counts.append(told.count(b",") + 1 if told else 0)
                ids_hex.append(hashlib.sha256(told).hexdigest())
                text_hex.append(hashlib.sha256(codec.text(found).encode("utf-8")).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def round_trip(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded.

    Null counts as empty: no ids, and the digest of nothing. Null and repeated ids are rows
    like any other; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(
        _round_trip(tokenizer), "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    )


def _ids(name: str):
    def run(batches):
        codec = _codec(name)
        for batch in batches:
            ids = [codec.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _texts(name: str):
    def run(batches):
        codec = _codec(name)
        for batch in batches:
            texts = [codec.decode(i or ()) for i in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encode(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and the ids of its text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_ids(tokenizer), "doc_id BIGINT, ids ARRAY<INT>")


def decode(rows: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and the text of its `ids`; null ids give an empty text."""
    return rows.select("doc_id", "ids").mapInArrow(_texts(tokenizer), "doc_id BIGINT, text STRING")
