"""Near duplicates by fast similarity sketches, banding and exact verification (operator 2).

1. One pass over the texts gives each row the digest of its shingle set and the digests of
   its sketch bands. Rows with equal sets become one class, so copies cost nothing further.
2. Classes that share a band are candidates, and their full sets are computed once. A shingle
   that only one candidate has is in no intersection, so a candidate with too many of its own
   can be linked with nothing and leaves. Members are compared with centres of their band: first
   with the smallest member, then, in bands whose members are not yet in one component, with 32,
   1024, ... members, those of the smallest components first, each time only with members of other
   components. A centre then leaves its band. As soon as the bands that are left make few pairs
   for their members, all of these are compared at once. When the rounds end, any two members of
   a band were compared or are connected, so no component is missed, and a band of near copies
   costs one comparison a member.
3. The join of a band looks at numbers of own shingles and at a bitmap of each set: no more bits
   differ than shingles, so both rule out pairs but no link, and the many pairs of a group that
   are nearly but not quite alike are not rows. What is left is confirmed on full sets.

With `rows` coordinates a band and `bands` bands, a pair of similarity s shares no band with
probability (1 - s**rows)**bands; `bands` is chosen so that this is at most `miss` at the
threshold itself, and it falls steeply above. The pairs that are found are exact.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from footfall.llm.components import components
from footfall.llm.shingles import shingle_sets, slices
from footfall.llm.sketches import bands, sketch
from footfall.llm.tables import hand_over, light, only_chosen, text_or_empty

#: Centres of a band in the second round, and how much their number grows from round to round.
FIRST, GROWTH = 32, 32

#: Pairs in bands that are compared at once, in all and for each member. Where there are more,
#: rounds of centres come first.
AT_ONCE, EACH = 20_000_000, 100

#: Numbers of 64 bits in the bitmap of a set, a power of two.
BITMAP = 16


def band_count(threshold: float, rows: int, miss: float) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def _signatures(width: int, rows: int, count: int):
    def run(batches):
        for batch in batches:
            for at, data, offsets in slices(batch.column("text")):
                sets = shingle_sets(data, offsets, width)
                keys = bands(sketch(sets, rows * count), rows).view(np.int64)
                nodes = b"".join(hashlib.sha256(s.tobytes()).digest()[:8] for s in sets)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(at, len(sets)),
                        batch.column("text_id").slice(at, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.frombuffer(nodes, np.int64)),
                        pa.array([k if len(s) else [] for k, s in zip(keys, sets)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_id", "n_shingles", "node", "bands"],
                )

    return run


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Bits set by the first bits of each shingle's digest, BITMAP numbers a set."""
    size = 64 * BITMAP
    table = np.zeros((len(sets), size), bool)
    for row, s in zip(table, sets):
        row[s >> np.uint64(64 - size.bit_length() + 1)] = True
    return np.packbits(table, axis=1).view(np.int64)


def _sets(width: int, rows: int, count: int):
    def run(batches):
        for batch in batches:
            for at, data, offsets in slices(batch.column("text")):
                sets = shingle_sets(data, offsets, width)
                keys = (bands(sketch(sets, rows * count), rows).view(np.int64) >> 32).astype(np.int32)
                numbers = pa.list_(pa.int64())
                yield pa.record_batch(
                    [
                        batch.column("node").slice(at, len(sets)), pa.array([s.view(np.int64) for s in sets], numbers),
                        pa.array(list(keys), pa.list_(pa.int32())), pa.array(list(_bitmaps(sets)), numbers),
                    ],
                    names=["node", "shingles", "bands", "bits"],
                )

    return run


def _with_text_id(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_id"), text_or_empty().alias("text")
    )


def _full_sets(
    nodes: DataFrame, most: int, heads: DataFrame, texts: DataFrame, width: int, rows: int, count: int
) -> DataFrame:
    """Full sets of some classes, `most` at most (node, shingles, bands, bits), from the text of one
    row each, with the first 32 bits of their bands, which two bands share by chance less often
    than `miss`. A row that is repeated gives its set once."""
    needed = heads.join(light(nodes.distinct(), most), "node", "left_semi").select("node", "head.doc_id", "head.text_id")
    needed = light(needed, most).alias("n")
    same = F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("t.text_id") == F.col("n.text_id"))
    some = texts.alias("t").join(needed, same).select("node", "text")
    kind = "node BIGINT, shingles ARRAY<BIGINT>, bands ARRAY<INT>, bits ARRAY<BIGINT>"
    sets = some.mapInArrow(_sets(width, rows, count), kind)
    return sets.groupBy("node").agg(*[F.first(c).alias(c) for c in ("shingles", "bands", "bits")])


def _linkable(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, own) of the sets that may be linked: `own` counts the shingles that no other of
    the sets has, and a link needs `percent` of the shingles in the other set, too."""
    each = sets.select("node", F.explode("shingles").alias("shingle"))
    lone = each.groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
    own = lone.groupBy("node").agg(F.count("*").alias("own"))
    sized = sets.select("node", F.size("shingles").cast("bigint").alias("n")).join(own, "node", "left")
    sized = sized.withColumn("own", F.coalesce("own", F.lit(0).cast("bigint")))
    return sized.where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))


def _alike(percent: int, n, m, a="a", b="b"):
    """100 * intersection >= percent * union, written so that the sets are intersected once."""
    return (100 + percent) * F.size(F.array_intersect(a, b)) >= percent * (n + m)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (u, v) whose full sets reach the threshold."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(a, "u").join(b, "v").where(_alike(percent, F.size("a"), F.size("b"))).select("u", "v")


def _reachable(percent: int):
    """The intersection holds no shingle that only one of the sets has."""
    n, m = F.col("n"), F.col("c_n")
    return (100 + percent) * F.least(n - F.col("own"), m - F.col("c_own")) >= percent * (n + m)


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, rows: int = 5, miss: float = 1e-6,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets, and
    component_id is the smallest doc_id that links reach. Null or empty texts, and texts of
    white space, have no shingles and are linked with nothing; other texts of fewer than `width`
    words are one shingle. A null id is never the smallest; a component without any id has a
    null component_id and keeps all its rows. Rows that repeat an id are linked by their own
    texts. An empty table gives an empty result; other columns are ignored.
    """
    return _decided(docs, percent, width, rows, miss).select("doc_id", "n_shingles", "component_id", "kept")


def _decided(docs: DataFrame, percent: int, width: int = 5, rows: int = 5, miss: float = 1e-6) -> DataFrame:
    """`near_duplicates` with `text_id`, a number for each row, and the label of its component,
    null for rows that are alone."""
    count = band_count(percent / 100, rows, miss)
    texts = _with_text_id(docs)
    signed = hand_over(
        texts.mapInArrow(
            _signatures(width, rows, count),
            "doc_id BIGINT, text_id BIGINT, n_shingles BIGINT, node BIGINT, bands ARRAY<BIGINT>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "near-signatures",
    )
    # rows with equal sets are one class, a node; one of its rows stands for it
    head = F.min(F.struct("row", "doc_id", "text_id", "bands")).alias("head")
    heads = hand_over(
        signed.where("n_shingles > 0").groupBy("node").agg(head, F.min("doc_id").alias("low"), F.count("*").alias("copies")),
        "near-classes",
    )
    entries = heads.select("node", F.explode("head.bands").alias("band"))
    shared = hand_over(entries.groupBy("band").agg(F.count("*").alias("c")).where("c > 1").select("band"), "near-bands")
    members = hand_over(entries.join(light(shared, shared.count()), "band"), "near-members")
    n_members = members.count()  # no fewer than the classes in them
    sets = hand_over(_full_sets(members.select("node"), n_members, heads, texts, width, rows, count), "near-sets")
    able = hand_over(_linkable(sets, percent), "near-linkable")
    rest, step, labels, most = members.join(light(able, n_members), "node"), 1, None, 0
    while n_members:
        members = hand_over(_split_bands(rest, labels, most), "near-open")
        n_members, ahead = members.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        if not n_members:
            break
        whole = False
        if step == 1:
            rest = members.where("node <> first.node")
            pairs = rest.withColumns({"c_n": F.col("first.n"), "c_own": F.col("first.own")}).where(_reachable(percent))
            pairs = pairs.select(F.col("first.node").alias("u"), F.col("node").alias("v")).distinct()
        else:
            whole = ahead <= 2 * max(AT_ONCE, EACH * n_members)
            if not whole:
                members = hand_over(_placed(members, step), "near-placed")
                rest = members.where(F.col("place") > step)
            pairs = _compare(members, None if whole else step, sets, percent)
        fresh = hand_over(_linked(pairs, sets, percent), "near-links")
        n_fresh = fresh.count()
        if n_fresh and labels is None:
            labels = components(fresh, n_fresh)
        elif n_fresh:
            labels = hand_over(_relabelled(light(labels, most), fresh, n_fresh), "near-labels")
        most += 2 * n_fresh  # no fewer than the labels
        if whole:
            break
        rest = rest.select("band", "node", "n", "own")
        step = step * GROWTH if step > 1 else FIRST

    # rows take the component of their class; only classes with copies or links are joined
    named = _labelled(heads.select("node", "low", "copies"), labels, most)
    named = named.where("copies > 1 OR label IS NOT NULL").withColumn("label", F.coalesce("label", "node"))
    low = named.groupBy("label").agg(F.min("low").alias("component_id"))
    found = named.join(low, "label").select("node", "label", "component_id")
    found = hand_over(found.withColumn("__found", F.lit(True)), "near-found")
    rows_ = signed.join(light(found, found.count()), "node", "left").withColumn(
        "component_id", F.when(F.col("__found"), F.col("component_id")).otherwise(F.col("doc_id"))
    )
    return rows_.select(
        "doc_id", "text_id", "n_shingles", "component_id",
        (F.col("component_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        "label", "row",
    )


def _relabelled(labels: DataFrame, fresh: DataFrame, n_fresh: int) -> DataFrame:
    """Labels after new links: what is searched again is the graph of labels that they join."""
    a, b = labels.alias("a"), labels.alias("b")
    joined = fresh.join(a, F.col("u") == F.col("a.node"), "left").join(b, F.col("v") == F.col("b.node"), "left")
    pairs = joined.select(F.coalesce("a.label", "u").alias("u"), F.coalesce("b.label", "v").alias("v")).distinct()
    merged = hand_over(components(pairs, n_fresh), "near-merged").select(F.col("node").alias("was"), F.col("label").alias("now"))
    merged = light(merged, 2 * n_fresh)
    old = labels.join(merged, F.col("label") == F.col("was"), "left").select("node", F.coalesce("now", "label").alias("label"))
    new = merged.join(labels, F.col("was") == F.col("node"), "left_anti")
    return old.unionByName(new.select(F.col("was").alias("node"), F.col("now").alias("label")))


def _labelled(rows: DataFrame, labels: DataFrame | None, most: int) -> DataFrame:
    """With the label of the node, null where it has none; there are `most` labels at most."""
    if labels is None:
        return rows.withColumn("label", F.lit(None).cast("bigint"))
    return rows.join(light(labels, most), "node", "left")


def _split_bands(rest: DataFrame, labels: DataFrame | None, most: int) -> DataFrame:
    """Members of the bands whose members lie in more than one component, with labels, the
    number of the band's members and the first of them."""
    named = _labelled(rest, labels, most).withColumn("label", F.coalesce("label", "node"))
    first = F.min(F.struct("node", "n", "own")).alias("first")
    sizes = named.groupBy("band").agg(F.count("*").alias("size"), first, F.min("label").alias("a"), F.max("label").alias("z"))
    return named.join(sizes.where("a <> z").select("band", "size", "first"), "band")


def _placed(members: DataFrame, step: int) -> DataFrame:
    """Members with `place`: up to `step` in the next centres of each band, those of the smallest
    components first, since once all but the largest component were centres, nothing is left to
    compare. Spark cuts each band to `step` rows before the shuffle."""
    kin = members.groupBy("band", "label").agg(F.count("*").alias("kin"))
    members = members.join(kin, ["band", "label"])
    place = F.row_number().over(W.partitionBy("band").orderBy("kin", "node"))
    centres = members.select("band", "node", "kin").withColumn("place", place).where(F.col("place") <= step)
    placed = members.join(centres.drop("kin"), ["band", "node"], "left")
    return placed.withColumn("place", F.coalesce("place", F.lit(step + 1)))


def _compare(members: DataFrame, step: int | None, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a centre of a band, or with no `step` of any member, and a member in another
    component that look like links by their own shingles and bitmaps; each in the first band it
    shares. Bitmaps are joined here only, so rows between rounds stay narrow."""
    if step is None:
        members = members.withColumn("place", F.col("node"))
    members = members.select("band", "node", "n", "own", "label", "place")
    members = members.join(sets.select("node", "bits", "bands"), "node")
    centre = members if step is None else members.where(F.col("place") <= step)
    centre = centre.select(*[F.col(c).alias("c_" + c) for c in members.columns])
    apart = sum(F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("c_bits", F.lit(i)))) for i in range(BITMAP))
    looks_linked = (
        (F.col("place") > F.col("c_place")) & (F.col("label") != F.col("c_label")) & _reachable(percent)
        & ((100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("c_n")))
        & (F.get(F.array_intersect("bands", "c_bands"), F.lit(0)) == F.shiftright("band", 32).cast("int"))
    )
    pairs = members.join(centre, (F.col("band") == F.col("c_band")) & looks_linked)
    return pairs.select(F.col("c_node").alias("u"), F.col("node").alias("v"))


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one row of each component, that with
    the smallest id (of equal ids any one; a null id only where there is no other). Rows without
    shingles all stay. Decisions are by id and text, so a repeated id does not mix rows."""
    rows = hand_over(_decided(docs, percent), "near-decided")
    grouped = rows.where("label IS NOT NULL")
    first = grouped.where("doc_id <=> component_id").groupBy("label").agg(F.min("row").alias("row"))
    chosen = grouped.join(first, ["label", "row"]).select("doc_id", "text_id")
    return only_chosen(docs, grouped.select("doc_id", "text_id"), chosen, "text_id")
