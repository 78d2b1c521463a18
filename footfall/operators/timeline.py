"""Running state per key that stays parallel when one key holds most rows.

`Timeline` adds columns such as "latest non-null value before this row". For
ordinary keys each of them is a plain window function, and because all share one
partitioning and ordering, Catalyst plans one exchange and one sort for the lot.

A window partition is one task, so a key with very many rows would be one huge
task. Those keys are found first with one pre-aggregated count.
Their rows are range partitioned on (key, order) into slices of about equal size,
the same window runs inside each slice, and a one-row summary of every earlier
(or later) slice is carried in. The result is exact; no row is dropped or sampled.

What a slice takes over from the one before, a run can take over from the run before: with
`keep`, every step also leaves its state after the last row of each key, and `snapshot` gives
one row per key with all of them. Given to the next run as `state`, it stands before the first
row of its key, in the same exchange as the rows. So operators written for Timeline go on from
day to day without the history, and none of them has code for it.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce, wraps
from math import ceil

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from footfall.schema import DEVICE, EVENT_ORDER
from footfall.scratch import hand_over

SLICE = "__slice"
_SEED, _HELD, _LATE = "__seed", "__held", "__late"

# A key with this many rows is hot, whatever the size of the table: it bounds what
# one task sorts.
HOT_ROWS = 5_000_000
SLICES_PER_LIMIT = 4  # smaller slices than the limit spread better over the tasks


@dataclass(frozen=True)
class HotKeys:
    """A table of the keys too large for one task, and how many rows they have together."""

    keys: DataFrame | None
    rows: int
    slice_rows: int

    def __bool__(self):
        return self.rows > 0

    @property
    def slices(self) -> int:
        return max(2, ceil(self.rows / self.slice_rows))


NO_HOT_KEYS = HotKeys(None, 0, HOT_ROWS)


def find_hot(rows: DataFrame, keys=DEVICE, floor=HOT_ROWS) -> HotKeys:
    """One count per key, combined before the shuffle. The hot keys stay a table."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    hot = hand_over(counts.where(F.col("n") >= floor), "hot-keys")
    total = hot.agg(F.sum("n")).first()[0] or 0
    return HotKeys(hot.select(*keys), total, max(1, floor // SLICES_PER_LIMIT)) if total else NO_HOT_KEYS


def _same(left: DataFrame, right: DataFrame, names) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right["__" + k]) for k in names])


def _prefixed(df: DataFrame, names) -> DataFrame:
    return df.withColumnsRenamed({n: "__" + n for n in names})


class Timeline:
    """Rows of a table in per-key order. Every method returns a new Timeline."""

    def __init__(
        self, rows: DataFrame, keys=DEVICE, order=EVENT_ORDER, hot: HotKeys | None = None,
        state: DataFrame | None = None, keep: bool = False,
    ):
        """`state` is the `snapshot` of the rows before these, `keep` lets this one be asked for
        its own. A row older than its key's snapshot has no place any more: it gets no state,
        gives none, and is marked in `__late` (see `late`)."""
        self.keys, self.order = tuple(keys), tuple(order)
        self.hot_keys = find_hot(rows, self.keys) if hot is None else hot
        self._fills, self._kept, self._keeps = 0, (), keep or state is not None
        self._known = set()
        if self._keeps:
            rows = self._seeded(rows, state)
        self._cold, self._hot = rows, None
        if self.hot_keys:
            self._split(rows)
        if self._keeps:
            self._take_over(state)

    def _seeded(self, rows: DataFrame, state: DataFrame | None) -> DataFrame:
        rows = rows.withColumn(_SEED, F.lit(False))
        if state is None:
            return rows
        self._known = {c for c in state.columns if c not in self.keys}
        # only the keys that have rows; Spark picks the join by its size
        asked = _prefixed(rows.select(*self.keys).distinct(), self.keys)
        seeds = state.join(asked, _same(state, asked, self.keys), "left_semi").select(
            *self.keys, F.struct(*sorted(self._known)).alias("__state"), F.lit(True).alias(_SEED)
        )
        return rows.unionByName(seeds, allowMissingColumns=True)

    def _take_over(self, state: DataFrame | None) -> None:
        if state is None:
            filled = self.set(**{_LATE: F.lit(False)})
        else:
            filled = self._fill([("last", _HELD, F.col("__state"))])
            late = ~F.col(_SEED) & F.coalesce(self._place() < F.col(f"{_HELD}.at"), F.lit(False))
            filled = filled.set(**{_LATE: late}).drop("__state")
        self._cold, self._hot = filled._cold, filled._hot

    def _place(self) -> Column:
        """Where a row stands, for comparison; a missing serial number counts as 0."""
        return F.struct(*[(F.coalesce(c, F.lit(0)) if c == "sn" else F.col(c)).alias(c) for c in self.order])

    def _split(self, rows: DataFrame) -> None:
        # a key in HOT_ROWS rows of the table; Spark picks the join by its size
        listed = _prefixed(self.hot_keys.keys.select(*self.keys), self.keys)
        same = _same(rows, listed, self.keys)
        self._cold = rows.join(listed, same, "left_anti")
        self._hot = (
            rows.join(listed, same, "left_semi")
            .repartitionByRange(self.hot_keys.slices, *self.keys, *self.order)
            .withColumn(SLICE, F.spark_partition_id())
        )

    def _with(self, cold, hot) -> "Timeline":
        out = object.__new__(Timeline)
        out.keys, out.order, out.hot_keys = self.keys, self.order, self.hot_keys
        out._fills, out._kept, out._keeps, out._known = self._fills, self._kept, self._keeps, self._known
        out._cold, out._hot = cold, hot
        return out

    def _each(self, change) -> "Timeline":
        return self._with(change(self._cold), None if self._hot is None else change(self._hot))

    # -- plain changes ---------------------------------------------------------

    def set(self, **columns) -> "Timeline":
        return self._each(lambda df: df.withColumns(columns))

    def where(self, condition) -> "Timeline":
        if self._keeps:
            condition = F.col(_SEED) | condition
        return self._each(lambda df: df.where(condition))

    def drop(self, *names) -> "Timeline":
        return self._each(lambda df: df.drop(*names))

    def frame(self, late: str | None = None) -> DataFrame:
        """The rows. `late` names a column for the mark of rows older than the state."""
        rows = self._all()
        if not self._keeps:
            return rows
        rows = rows.where(~F.col(_SEED)).drop(_SEED, _HELD, *self._kept)
        return rows.withColumnRenamed(_LATE, late) if late else rows.drop(_LATE)

    def _all(self) -> DataFrame:
        if self._hot is None:
            return self._cold
        return self._cold.unionByName(self._hot.drop(SLICE))

    def settled(self, label: str = "timeline") -> "Timeline":
        """The same by way of a table, for those who read both rows and snapshot."""
        return self._with(hand_over(self._all(), label), None)

    def snapshot(self) -> DataFrame:
        """The state after the rows: one row for each key that has rows which are not late."""
        fields = [F.col(c).alias(c.removeprefix("__kept_")) for c in self._kept]
        last = F.max_by(F.struct(*fields, self._place().alias("at")), self._place())
        rows = self._all().where(~F.col(_SEED) & ~F.col(_LATE))
        found = rows.groupBy(*self.keys).agg(last.alias("__last"))
        return found.select(*self.keys, "__last.*")

    @property
    def columns(self):
        hidden = (_SEED, _HELD, _LATE, *self._kept)
        return [c for c in self._cold.columns if c not in hidden]

    # -- running state ---------------------------------------------------------

    def last(self, **state) -> "Timeline":
        """Latest non-null value up to and including the row."""
        return self.fill(last=state)

    def before(self, **state) -> "Timeline":
        """Latest non-null value strictly before the row."""
        return self.fill(before=state)

    def next(self, **state) -> "Timeline":
        """Earliest non-null value from the row on. Runs backwards: a frame that
        reaches to the end would be evaluated anew for every row."""
        return self.fill(next=state)

    def total(self, **state) -> "Timeline":
        """Running sum up to and including the row."""
        return self.fill(total=state)

    def lowest(self, **state) -> "Timeline":
        """Running minimum up to and including the row."""
        return self.fill(lowest=state)

    def fill(self, **kinds: dict[str, Column]) -> "Timeline":
        """Several kinds of state at once, such as `last={...}, before={...}`. For
        hot keys one pass over the table serves them all."""
        steps = [(kind, n, v) for kind, state in kinds.items() for n, v in state.items()]
        if not self._keeps:
            return self._fill(steps)
        counts = ~(F.col(_SEED) | F.col(_LATE))
        own = [(kind, n, F.when(counts, v)) for kind, n, v in steps]
        # the state after a row; what looks back strictly does not include the row itself
        kept = {n: f"__kept_{self._fills}_{n}" for kind, n, _ in steps if kind != "next"}
        if any(kind == "peak" for kind, _, _ in steps):
            raise ValueError("peak is not carried between runs")
        out = self._fill(own + [("last", kept[n], v) for kind, n, v in own if kind == "before"])

        def with_held(kind: str, local: str, n: str) -> Column:
            field = f"{self._fills}_{n}"
            if kind == "next" or field not in self._known:
                return F.col(local)
            return _STEPS[kind].merge(F.col(local), F.col(f"{_HELD}.{field}"))

        merged = {}
        for kind, n, _ in own:
            merged[n] = F.when(~F.col(_LATE), with_held(kind, n, n))
            if kind == "before":
                merged[kept[n]] = with_held("last", kept[n], n)
            elif kind != "next":
                merged[kept[n]] = with_held(kind, n, n)
        out = out.set(**merged)
        out._fills, out._kept = self._fills + 1, (*self._kept, *kept.values())
        return out

    def _fill(self, named: list) -> "Timeline":
        steps = [(_STEPS[kind], n, v) for kind, n, v in named]

        def window(keys, order, step, end):
            way = [
                F.col(c).desc_nulls_last() if step.backwards else F.col(c).asc_nulls_first()
                for c in order
            ]
            return W.partitionBy(*keys).orderBy(*way).rowsBetween(W.unboundedPreceding, end)

        def windowed(df, keys):
            return df.withColumns(
                {n: step.run(v).over(window(keys, self.order, step, step.end)) for step, n, v in steps}
            )

        cold = windowed(self._cold, self.keys)
        if self._hot is None:
            return self._with(cold, None)

        rows = hand_over(self._hot, "timeline")  # read twice below
        sliced = (*self.keys, SLICE)
        summary = rows.groupBy(*sliced).agg(
            *[step.summarise(v, F.struct(*self.order)).alias(n) for step, n, v in steps]
        )
        carried = summary.select(
            *[F.col(k).alias("__" + k) for k in sliced],
            *[
                step.run(F.col(n)).over(window(self.keys, (SLICE,), step, -1)).alias("__carry_" + n)
                for step, n, _ in steps
            ],
        )
        inside = windowed(rows, sliced)
        hot = (
            # one carried row per slice; Spark picks the join by its size
            inside.join(carried, _same(inside, carried, sliced), "left")
            .withColumns({n: step.merge(F.col(n), F.col("__carry_" + n)) for step, n, _ in steps})
            .drop(*["__" + k for k in sliced], *["__carry_" + n for _, n, _ in steps])
        )
        return self._with(cold, hot)


def _last(c: Column) -> Column:
    return F.last(c, ignorenulls=True)


def _newest(c: Column, order: Column) -> Column:
    return F.max_by(c, F.when(c.isNotNull(), order))


def _oldest(c: Column, order: Column) -> Column:
    return F.min_by(c, F.when(c.isNotNull(), order))


def _add(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


@dataclass(frozen=True)
class _Step:
    """`run` over a window, `summarise` a slice, `merge` a value with the carried."""

    run: Callable
    summarise: Callable
    merge: Callable = F.coalesce
    end: int = 0
    backwards: bool = False


_STEPS = {
    "last": _Step(_last, _newest),
    "before": _Step(_last, _newest, end=-1),
    "next": _Step(_last, _oldest, backwards=True),
    "total": _Step(F.sum, lambda c, _: F.sum(c), _add),
    "lowest": _Step(F.min, lambda c, _: F.min(c), F.least),
    "peak": _Step(F.max, lambda c, _: F.max(c), F.greatest, end=-1),
}


def on_timeline(operator):
    """Let an operator written for Timeline also take and return a DataFrame.
    Chain on one Timeline to share the exchange and the search for hot keys."""

    @wraps(operator)
    def run(events, *args, hot: HotKeys | None = None, **kwargs):
        if isinstance(events, Timeline):
            return operator(events, *args, **kwargs)
        return operator(Timeline(events, hot=hot), *args, **kwargs).frame()

    return run
