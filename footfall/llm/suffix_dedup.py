"""Removing repeated 200-byte strings by difference-cover suffix sorting (operator 9).

1. Equal texts are one text with a count. A text that occurs twice is repeated as a whole.
2. Content-defined anchors deal the windows of all texts to groups: equal windows have equal
   anchor strings at the same distance (`anchors`). Anchors that occur once own no repeat.
   Anchors whose windows cover equal bytes are repeated altogether, which settles the inside
   of long repeats and all but one of many near copies.
3. What is left, the ends of repeats and one representative of each settled kind they might
   meet, is cut into short strings. Strings are grouped by the digest of the bytes common to
   all their windows; groups of one hold no repeat. The groups are dealt to tasks and their
   suffixes sorted and merged by the difference-cover algorithm (`suffixes`), whose sorted
   neighbours with 200 common bytes are the repeats. Windows of groups above `GROUP` strings are
   counted by digest instead, combined in the map tasks, so no task holds such a group.
4. The removed ranges of each text are merged and applied to its bytes.

Nothing but anchors, digests and short strings is shuffled. Groups are runs of sorted rows; a
task holds about `CHUNK` bytes of them at a time, and one group of `GROUP` strings more at most.
Group members have different surroundings within 231 bytes, and share their middle.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from footfall.llm.anchors import LENGTH, text_anchors
from footfall.llm.suffixes import DEPTH, repeated_windows
from footfall.llm.tables import digest, hand_over, light, text_or_empty

#: Windows of a short string; they share LENGTH - BLOCK + 1 bytes.
BLOCK = 32
#: Bytes of short strings that are sorted at a time.
CHUNK = 500_000
#: Short strings of one group that may meet in a task.
GROUP = 2_000

TEXT = ("rid", "did")  # what identifies a text: the smallest id with it, and its digest's hash


def _rows(batch, *names, step=256):
    """The rows of a batch, of which `step` at a time are Python objects."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield from zip(*(part.column(c).to_pylist() for c in names))


def _anchors(batches):
    for batch in batches:
        rids, dids = batch.column("rid"), batch.column("did")
        for rows, digests, place, first, count, covered in text_anchors(batch.column("text")):
            take = pa.array(rows)
            yield pa.record_batch(
                [
                    rids.take(take), dids.take(take), pa.array(digests.view(np.int64)),
                    pa.array(covered.view(np.int64)), pa.array(place), pa.array(first), pa.array(count.astype(np.int32)),
                ],
                names=[*TEXT, "anchor", "covered", "place", "first", "count"],
            )


def _cut(batches):
    """Short strings of the probed anchors: at most BLOCK windows, aligned to the distance from
    the anchor, so that equal windows fall into strings with equal common bytes."""
    names = [*TEXT, "core", "first", "bytes"]
    for batch in batches:
        rows = []
        for rid, did, text, probes in _rows(batch, *TEXT, "text", "probes"):
            data = text.encode("utf-8")
            for p in probes:
                a, end, place = p["first"], p["first"] + p["count"], p["place"]
                while a < end:
                    far = (place - a) // BLOCK
                    b = min(end, place - far * BLOCK + 1)
                    low, high = place - far * BLOCK, place - (far + 1) * BLOCK + 1 + LENGTH
                    core = data[low:high]
                    key = hashlib.blake2b(core, digest_size=16, salt=far.to_bytes(8, "big")).digest()
                    rows.append((rid, did, key, a, data[a : b - 1 + LENGTH]))
                    a = b
            if len(rows) >= 4096:
                yield _batch(rows, names)
                rows = []
        if rows:
            yield _batch(rows, names)


def _batch(rows, names):
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _windows(batches):
    """Every window of short strings: its digest and where it begins."""
    for batch in batches:
        for part in (batch.slice(at, 1024) for at in range(0, batch.num_rows, 1024)):
            rows = [
                (rid, did, first + k, hashlib.blake2b(data[k : k + LENGTH], digest_size=16).digest())
                for rid, did, first, data in _rows(part, *TEXT, "first", "bytes")
                for k in range(len(data) - LENGTH + 1)
            ]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*TEXT, "start", "window"])


def _counted(strings: DataFrame) -> DataFrame:
    """Repeated ranges of groups of any size. Equal windows lie in strings of one group, so
    windows are counted without it."""
    windows = strings.mapInArrow(_windows, "rid BIGINT, did BIGINT, start BIGINT, window BINARY")
    twice = hand_over(
        windows.groupBy("window").agg(F.count("*").alias("c")).where("c > 1").select("window"), "repeat-windows"
    )
    hit = windows.join(light(twice, twice.count()), "window", "left_semi")
    return hit.select(*TEXT, "start", (F.col("start") + LENGTH).alias("end"))


def _sort(batches):
    """Repeated ranges (rid, did, start, end) of rows sorted by core."""

    def flush(rows):
        data = np.frombuffer(b"".join([r[3] for r in rows]), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])])
        hit = np.flatnonzero(repeated_windows(data, offsets))
        if not len(hit):
            return None
        # runs of neighbouring windows of one string
        owner = np.searchsorted(offsets, hit, side="right") - 1
        fresh = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(owner) > 0)])
        begin = np.flatnonzero(fresh)
        last = np.concatenate([begin[1:] - 1, [len(hit) - 1]])
        who = owner[begin]
        base = np.array([r[2] for r in rows], np.int64)[who] - offsets[who]
        return pa.record_batch(
            [
                pa.array(np.array([r[0] for r in rows], np.int64)[who]), pa.array(np.array([r[1] for r in rows], np.int64)[who]),
                pa.array(hit[begin] + base), pa.array(hit[last] + base + DEPTH),
            ],
            names=[*TEXT, "start", "end"],
        )

    held, size, core = [], 0, None
    for batch in batches:
        for row in _rows(batch, *TEXT, "first", "bytes", "core"):
            if size >= CHUNK and row[4] != core:
                if (out := flush(held)) is not None:
                    yield out
                held, size = [], 0
            held.append(row[:4])
            size, core = size + len(row[3]), row[4]
    if held and (out := flush(held)) is not None:
        yield out


def _apply(batches):
    """What is left of each text after its removed ranges (sorted by start)."""
    names = [*TEXT, "n_removed", "n_spans", "kept_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        rows = []
        for rid, did, text, spans in _rows(batch, *TEXT, "text", "spans"):
            data, at, removed, runs = text.encode("utf-8"), 0, 0, 0
            kept, reached = hashlib.sha256(), -1
            for s in spans:
                if s["start"] > reached:  # a new run; ranges that touch are one
                    kept.update(data[at : s["start"]])
                    runs, removed, at, reached = runs + 1, removed + s["end"] - s["start"], s["end"], s["end"]
                elif s["end"] > reached:
                    removed, at, reached = removed + s["end"] - reached, s["end"], s["end"]
            kept.update(data[at:])
            rows.append((rid, did, removed, runs, kept.hexdigest()))
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _runs(ranges: DataFrame) -> DataFrame:
    """Ranges of a text merged where they touch; neighbouring anchors give one run."""
    order = W.partitionBy(*TEXT).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(F.coalesce(F.col("start") > reached, F.lit(True)), 1).otherwise(0)
    run = F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        ranges.withColumn("fresh", fresh).withColumn("run", run)
        .groupBy(*TEXT, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes when a 200-byte string that covers it begins anywhere else too, in the same text
    included. Strings are judged on the whole input and never cross texts. Null counts as
    empty; texts under 200 bytes lose nothing. Null and repeated ids are rows like any other;
    an empty table gives an empty result; other columns are ignored.
    """
    rid = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1).cast("bigint"))
    keyed = hand_over(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), rid.alias("rid"), digest().alias("digest"),
            F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"),
        ),
        "repeat-digests",
    )
    groups = keyed.where(F.col("n_bytes") >= LENGTH).groupBy("digest").agg(F.min("rid").alias("rid"), F.count("*").alias("c"))
    copied = hand_over(groups.where("c > 1").select("digest", "rid"), "repeat-copies")
    later = keyed.join(copied.withColumnRenamed("rid", "head"), "digest").where("rid <> head")
    later = hand_over(later.select("rid", F.xxhash64("digest").alias("did")).distinct(), "repeat-later")

    texts = docs.select(rid.alias("rid"), F.xxhash64(digest()).alias("did"), text_or_empty().alias("text"))
    texts = texts.where(F.octet_length("text") >= LENGTH).join(light(later, later.count()), list(TEXT), "left_anti")
    anchors = hand_over(
        texts.mapInArrow(_anchors, "rid BIGINT, did BIGINT, anchor BIGINT, covered BIGINT, place BIGINT, first BIGINT, count INT"),
        "repeat-anchors",
    )
    # anchors that occur once are most of them: their strings alone are counted, and they go first
    shared = hand_over(anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "repeat-shared")
    common = hand_over(anchors.join(light(shared, shared.count()), "anchor", "left_semi"), "repeat-common")
    kind = ["anchor", "covered"]
    kinds = common.groupBy(*kind).agg(F.count("*").alias("c"), F.min(F.struct(*TEXT, "first")).alias("head"))
    kinds = hand_over(kinds, "repeat-kinds")
    roles = kinds.join(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")), "anchor")
    found = common.join(roles, kind).select(
        *TEXT, "place", "first", "count",
        (F.col("c") > 1).alias("settled"),
        ((F.col("kinds") > 1) & ((F.col("c") == 1) | (F.struct(*TEXT, "first") == F.col("head")))).alias("probe"),
    )
    found = hand_over(found, "repeat-found")

    probes = found.where("probe").groupBy(*TEXT).agg(F.collect_list(F.struct("place", "first", "count")).alias("probes"))
    probes = light(hand_over(probes, "repeat-probes"), found.where("probe").count())
    strings = hand_over(
        texts.join(probes, list(TEXT)).mapInArrow(_cut, "rid BIGINT, did BIGINT, core BINARY, first BIGINT, bytes BINARY"),
        "repeat-strings",
    )
    cores = hand_over(strings.groupBy("core").agg(F.count("*").alias("c")).where("c > 1"), "repeat-cores")
    large = cores.where(F.col("c") > GROUP).select("core")
    n_large = large.count()
    few = strings.join(light(large, n_large), "core", "left_anti") if n_large else strings
    dealt = few.join(cores.where(F.col("c") <= GROUP).select("core"), "core").repartition("core").sortWithinPartitions("core")
    sorted_ranges = dealt.mapInArrow(_sort, "rid BIGINT, did BIGINT, start BIGINT, end BIGINT")
    if n_large:
        many = strings.join(light(large, n_large), "core", "left_semi")
        sorted_ranges = sorted_ranges.unionByName(_counted(many))
    settled = found.where("settled").select(
        *TEXT, F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + LENGTH).alias("end")
    )
    # texts that occur twice go as a whole
    whole = copied.select("rid", F.xxhash64("digest").alias("did"))
    ranges = _runs(settled.unionByName(sorted_ranges).join(whole, list(TEXT), "left_anti"))
    spans = hand_over(
        ranges.groupBy(*TEXT).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")), "repeat-spans"
    )
    runs = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    touched = hand_over(
        texts.join(light(spans, runs), list(TEXT)).mapInArrow(
            _apply, "rid BIGINT, did BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"
        ),
        "repeat-touched",
    )
    rows = keyed.join(copied.select("digest", F.lit(True).alias("whole")), "digest", "left").withColumn("did", F.xxhash64("digest"))
    rows = rows.join(touched, list(TEXT), "left")
    nothing = hashlib.sha256().hexdigest()
    return rows.select(
        "doc_id", "n_bytes",
        F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("whole"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(F.col("whole"), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )
