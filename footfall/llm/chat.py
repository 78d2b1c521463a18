"""Chat formatting with offset-aligned loss masks (operator 10).

A conversation is rendered by a template in which every turn is

    <s>[INST] role\\n text [/INST]</s>\\n

with the control strings written inside texts escaped reversibly. The rendered text is
encoded once with character offsets. Turn spans and token spans are both sorted, so the
tokens of an assistant text are found by binary search; the loss mask is one per token that
meets such a span, and the loss text is the meeting of both, so a token that straddles the end
of a text adds no character from outside.

Rows are dealt by conversation and sorted inside their partition by Spark, which spills. A
Python worker then reads the turns as a stream: a conversation is rendered and encoded in
chunks of whole turns, each turn once, and digests are carried along, so even a conversation
with a third of all rows is held a chunk at a time. Turns end with a line feed before a
control string, where the vocabulary's split pattern always cuts; so chunks encode to the
same tokens as the conversation in one piece.
"""

import hashlib
import os
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.tables import tokenizer_path

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>\n"

#: Inside texts and roles the escape character and the first characters of the control
#: strings are written as the escape character and a letter, so no control string and no end
#: of a role is left. Fixed values.
ESCAPE = "\\"
CODES = {"\\": "\\e", "<": "\\l", "[": "\\b"}
ROLE_CODES = CODES | {"\n": "\\n"}

#: Characters of turns that are rendered and encoded at a time, one turn at least.
CHUNK = 1 << 20

_ENCODERS: dict[str, object] = {}


def escape(text: str, codes=CODES) -> str:
    for c, code in codes.items():  # the escape character comes first
        text = text.replace(c, code)
    return text


def unescape(text: str, codes=ROLE_CODES) -> str:
    if ESCAPE not in text:
        return text
    back = {code[1]: c for c, code in codes.items()}
    pieces = text.split(ESCAPE)
    out, i = [pieces[0]], 1
    while i < len(pieces):
        out.append(back[pieces[i][0]] + pieces[i][1:])
        i += 1
    return "".join(out)


def render(turns) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text of (role, text) turns, and the sorted spans of the assistant texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role, ROLE_CODES) + "\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        piece = head + body + MIDDLE + CLOSE
        out.append(piece)
        at += len(piece)
    return "".join(out), spans


def read_back(formatted: str):
    """(role, text) turns of a formatted text."""
    at = 0
    while at < len(formatted):
        end = formatted.index(MIDDLE + CLOSE, at)
        role, text = formatted[at + len(OPEN) : end].split("\n", 1)
        yield unescape(role), unescape(text)
        at = end + len(MIDDLE) + len(CLOSE)


def token_mask(starts: list[int], ends: list[int], spans) -> list[bool]:
    """True for tokens that meet a span. Both are sorted, so each span is two searches."""
    mask = [False] * len(starts)
    for a, b in spans:
        for i in range(bisect_right(ends, a), bisect_left(starts, b)):
            mask[i] = starts[i] < ends[i]
    return mask


def loss_spans(starts, ends, mask, spans) -> list[tuple[int, int]]:
    """Characters under the mask: where masked tokens and spans meet, each character once.
    Tokens that share a character, as parts of one, give it only once."""
    out = []
    for a, b in spans:
        done = a
        for i in range(bisect_right(ends, a), bisect_left(starts, b)):
            if mask[i]:
                low, high = max(starts[i], done), min(ends[i], b)
                if low < high:
                    out.append((low, high))
                    done = high
    return out


def encoder(path: str):
    """text -> (ids, starts, ends) by the tokenizers library, without truncation."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_padding()
        library.no_truncation()

        def run(text):
            found = library.encode(text, add_special_tokens=False)
            offsets = found.offsets
            return found.ids, [a for a, _ in offsets], [b for _, b in offsets]

        _ENCODERS[path] = run
    return _ENCODERS[path]


PART = (
    "conv_id BIGINT, part INT, last BOOLEAN, formatted STRING, input_ids ARRAY<INT>, "
    "loss_mask ARRAY<BOOLEAN>, starts ARRAY<INT>, ends ARRAY<INT>, spans ARRAY<ARRAY<INT>>"
)
PART_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("formatted", pa.string()),
    ("input_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())),
    ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("spans", pa.list_(pa.list_(pa.int32()))),
])


def _chunks(batches):
    """(conv_id, part, is it the last, turns) from rows sorted by conversation and turn."""
    current, turns, size, part, begun = None, [], 0, 0, False
    for batch in batches:
        ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conv, role, text in zip(ids, roles, texts):
            if begun and (conv != current or size >= CHUNK):
                yield current, part, conv != current, turns
                part, turns, size = (part + 1 if conv == current else 0), [], 0
            begun, current = True, conv
            turns.append((role, text))
            size += len(text)
    if begun:
        yield current, part, True, turns


def _format(tokenizer: str):
    def run(batches):
        encode = encoder(tokenizer_path(tokenizer))
        held, size = [], 0
        for conv, part, last, turns in _chunks(batches):
            formatted, spans = render(turns)
            ids, starts, ends = encode(formatted)
            held.append({
                "conv_id": conv, "part": part, "last": last, "formatted": formatted, "input_ids": ids,
                "loss_mask": token_mask(starts, ends, spans), "starts": starts, "ends": ends, "spans": spans,
            })
            size += len(formatted)
            if size >= CHUNK:
                yield pa.RecordBatch.from_pylist(held, PART_SCHEMA)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, PART_SCHEMA)

    return run


def format_chats(conversations: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Formatted conversations in parts of whole turns: text, ids, loss mask, offsets, spans.

    Rows of a conversation are ordered by turn, then role and text; a null turn comes first,
    repeated rows are turns of their own. Null text or role counts as empty; rows with a null
    conv_id are one conversation. Parts of a conversation are neighbours in one partition, in
    order; a conversation of up to a million characters is one part. An empty table gives no
    parts; other columns are ignored.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format(tokenizer), PART)


def _digest(batches):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    turns = chars = total = 0
    told, loss = hashlib.sha256(), hashlib.sha256()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            for role, text in read_back(row["formatted"]):
                told.update(f"{role}\n{text}\n".encode("utf-8"))
                turns += 1
            total += len(row["formatted"])
            # unescape per assistant text, as an escape may span two tokens
            spans = row["spans"]
            under = loss_spans(row["starts"], row["ends"], row["loss_mask"], spans)
            first = [a for a, _ in under]
            for a, b in spans:
                pieces = under[bisect_left(first, a) : bisect_left(first, b)]
                text = unescape("".join(row["formatted"][x:y] for x, y in pieces))
                chars += len(text)
                loss.update(text.encode("utf-8"))
            if row["last"]:
                out.append((row["conv_id"], turns, told.hexdigest(), chars, loss.hexdigest(), total))
                turns = chars = total = 0
                told, loss = hashlib.sha256(), hashlib.sha256()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], pa.schema(list(zip(
                names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            ))))


def summarise(parts: DataFrame) -> DataFrame:
    """Digests read back from what `format_chats` returned, one row per conversation. It reads
    the parts as they lie, so nothing may shuffle them in between."""
    return parts.mapInArrow(
        _digest,
        "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT",
    )
