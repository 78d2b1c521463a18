"""Balanced label propagation into shards (operator 6).

Documents with equal texts are linked. Every shard has a quota of rows, the quotas differ
by one at most. Linked documents start evenly spread. In each round they see how many of
their neighbours lie in each shard, and wish to move to the shard with most of them. From the
number of wishes between each two shards, the most moves are found that leave every shard
within its quota, places that are vacated in the round included, so full shards swap rows.
Movers are admitted up to that number, largest groups first. If none is, wishes go to shards
with free places only, then other shards win the ties; rounds end when that admits nobody
either. Documents without links cut no edge anywhere and fill what is left.

Neighbours are counted per (group, shard), never as pairs, and all members of a group in
one shard decide alike, so a round works on at most `shards` rows per group plus one join
back to the members. A group larger than a quota fills its best shard and goes on with the
next best. Numbers are given in hash buckets, so no shard is sorted in one task.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.tables import digest, hand_over, numbered, text_or_empty

#: Orders of ties that are tried in a row without a move before rounds end.
TIES = 3


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (t < rows % shards) for t in range(shards)]


def _pick(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), shard + 1)


def _loads(linked: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["count"] for r in linked.groupBy("shard").count().collect()}
    return [found.get(t, 0) for t in range(shards)]


def _admitted(wished: np.ndarray, free: list[int]) -> np.ndarray:
    """Most moves [from, to] of those wished that raise no shard by more than its free places.

    Moves are pushed along cycles of shards (the last node stands for free places) as long as
    a cycle adds more moves than it takes back."""
    n = len(free)
    moves, taken, rest = np.zeros_like(wished), np.zeros(n, np.int64), np.array(free, np.int64)
    never = -(1 << 40)
    while True:
        more = wished - moves
        gain, most = np.full((n + 1, n + 1), never), np.zeros((n + 1, n + 1), np.int64)
        gain[:n, :n] = np.where(more > 0, 1, np.where(moves.T > 0, -1, never))
        most[:n, :n] = np.where(more > 0, more, moves.T)
        gain[:n, n] = np.where(rest - taken > 0, 0, never)
        most[:n, n] = rest - taken
        gain[n, :n], most[n, :n] = 0, 1 << 62
        far, came = np.zeros(n + 1, np.int64), np.full(n + 1, -1)
        for _ in range(n + 1):
            through = far[:, None] + gain
            better = through.max(axis=0)
            raised = better > far
            came[raised] = through.argmax(axis=0)[raised]
            far = np.maximum(far, better)
        if not raised.any():
            return moves
        at = int(np.flatnonzero(raised)[0])
        for _ in range(n + 1):
            at = int(came[at])
        cycle = [at]
        while (before := int(came[cycle[-1]])) != at:
            cycle.append(before)
        steps = [(int(came[t]), t) for t in cycle]
        step = min(int(most[e]) for e in steps)
        for a, b in steps:
            if b == n:
                taken[a] += step
            elif a == n:
                taken[b] -= step
            elif gain[a, b] > 0:
                moves[a, b] += step
            else:
                moves[b, a] -= step


def _round(
    linked: DataFrame, quota: list[int], load: list[int], turn: int, full_too: bool
) -> tuple[DataFrame, np.ndarray] | None:
    """One step: the members after it, and how many moved between which shards. None when
    nobody wants to move."""
    shards, free = len(quota), [q - n for q, n in zip(quota, load)]
    cells = linked.groupBy("group", "shard").agg(F.count("*").alias("n"))
    # members that fill a whole shard stay, and the others see the remaining shards
    cells = cells.where(F.col("n") < _pick(quota, F.col("shard")))
    # between equal counts each group prefers a shard of its own, so that ties spread
    tie = F.pmod(F.xxhash64("group", F.lit(turn)) + F.col("shard"), F.lit(shards))
    rank = F.struct("n", tie.alias("tie"), "shard")
    room = F.lit(True) if full_too else F.col("shard").isin([t for t in range(shards) if free[t] > 0])
    best = cells.groupBy("group").agg(F.max(F.when(room, rank)).alias("best"))
    wishes = (
        cells.withColumn("own", rank)
        .join(best, "group")
        .where(F.col("best") > F.col("own"))
        .select("group", "shard", "n", F.col("best.shard").alias("target"), (-F.log2(F.col("best.n"))).cast("int").alias("prio"))
    )
    wishes = hand_over(wishes, "shard-wishes")
    wished = np.zeros((shards, shards), np.int64)
    for r in wishes.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect():
        wished[r["shard"], r["target"]] = r["n"]
    if not wished.any():
        return None
    moves = _admitted(wished, free)
    if not moves.any():
        return linked, moves
    asked = hand_over(linked.join(wishes.drop("n"), ["group", "shard"], "left"), "shard-asked")
    movers = numbered(
        asked.where("target IS NOT NULL"), "place", ["node"], ["shard", "target"], ["prio"], rows=int(wished.sum())
    )
    admitted = F.col("place") < _pick(moves.ravel().tolist(), F.col("shard") * shards + F.col("target"))
    moved = movers.withColumn("shard", F.when(admitted, F.col("target")).otherwise(F.col("shard")))
    stay = asked.where("target IS NULL")
    after = stay.select(linked.columns).unionByName(moved.select(linked.columns))
    return hand_over(after, "shard-round"), moves


def _propagate(linked: DataFrame, quota: list[int], load: list[int]) -> tuple[DataFrame, list[int]]:
    """Rounds until no move is admitted, in any of TIES orders of ties; members and loads."""
    turn = idle = 0
    while idle < TIES:
        for full_too in (True, False):
            found = _round(linked, quota, load, turn, full_too)
            if found is None:
                if full_too:
                    return linked, load
                continue
            linked, moves = found
            if moves.any():
                load = [int(x) for x in np.array(load) + moves.sum(0) - moves.sum(1)]
                idle = -1
                break
        turn, idle = turn + 1, idle + 1
    return linked, load


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard.

    Shard sizes differ by one row at most; slots are gapless from 0 in each shard. A null text
    counts as empty (size 1, and linked to the empty texts). Null or repeated ids are rows like
    any other. An empty table gives an empty result. Other columns are ignored. Each move
    raises the number of neighbours that share a shard, so the rounds end by themselves.
    """
    base = hand_over(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text_or_empty()) + 1).cast("bigint").alias("size"),
            F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
            digest().alias("group"),
        ),
        "shard-documents",
    )
    rows = base.count()
    groups = hand_over(
        base.groupBy("group").agg(F.count("*").alias("copies")).where("copies > 1")
        .select("group", F.monotonically_increasing_id().alias("number")), "shard-groups"
    )
    same = ["doc_id", "group"]
    linked = numbered(base.join(groups, "group"), "node", same)
    linked = hand_over(
        linked.withColumn("shard", F.pmod("node", F.lit(shards)).cast("int")), "shard-linked"
    )
    quota = quotas(rows, shards)
    # rounds work on three numbers a row
    members, load = _propagate(
        linked.select("node", F.col("number").alias("group"), "shard"), quota, _loads(linked, shards)
    )
    linked = linked.drop("shard").join(members.select("node", "shard"), "node")

    out = ["doc_id", "size", "text_crc32", "shard", "slot"]
    placed = numbered(linked, "slot", ["node"], ["shard"], rows=max(1, sum(load) // shards)).select(out)
    ends, at = [], 0
    for q, n in zip(quota, load):
        at += q - n
        ends.append(at)
    single = numbered(base.join(groups, "group", "left_anti"), "place", same, rows=rows - sum(load))
    shard = F.coalesce(*[F.when(F.col("place") < end, F.lit(t)) for t, end in enumerate(ends)], F.lit(shards - 1))
    single = single.withColumn("shard", shard.cast("int"))
    start = [n - (end - (q - n)) for q, n, end in zip(quota, load, ends)]
    single = single.withColumn("slot", F.col("place") + _pick(start, F.col("shard"))).select(out)
    return placed.unionByName(single).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
