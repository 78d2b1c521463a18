"""Runs that go on from a snapshot give what one run over everything gives."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import track
from footfall.operators import context, identity, sessions
from footfall.operators.timeline import NO_HOT_KEYS, HotKeys, Timeline
from footfall.schema import DEVICE
from footfall.scratch import hand_over
from tests.conftest import rows_of
from tests.helpers import DAY, HOUR, events

NAMES = "projectId siteId deviceId eventTime sn eventName eventBody url title userId userProperty".split()


def everything(line):
    line = sessions.visit_counters(sessions.sessionize_v1(line))
    line = sessions.sessionize_v2(line.drop("seStartTime"))
    line = context.page_context(context.attribute_campaign(line))
    line = identity.carry_registration(identity.carry_user_property(identity.carry_user(line)))
    return line.total(n=F.lit(1).cast("bigint")).lowest(least=F.col("sn"))


def day_by_day(parts, hot=NO_HOT_KEYS, late=None):
    """Rows of all parts, and the snapshot of every key."""
    state, out = None, []
    for part in parts:
        line = everything(Timeline(part, hot=hot, state=state, keep=True)).settled()
        out.append(line.frame(late))
        new = line.snapshot()
        if state is not None:
            new = new.unionByName(state.join(new.select(*DEVICE), list(DEVICE), "left_anti"))
        state = hand_over(new, "state")
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows, state


@pytest.fixture(scope="module")
def rows(spark, sf):
    return hand_over(track(spark, sf, *NAMES), "rows")


def test_parts_by_time_equal_one_run(rows):
    cuts = [0, DAY + 3 * 24 * HOUR + 5 * HOUR, DAY + 4 * 24 * HOUR, DAY + 15 * 24 * HOUR, 10**14]
    parts = [rows.where(F.col("eventTime").between(a, b - 1)) for a, b in zip(cuts, cuts[1:])]
    got, state = day_by_day(parts)
    want = everything(Timeline(rows, hot=NO_HOT_KEYS)).frame()
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert rows_of(got, *names) == rows_of(want, *names)
    assert state.count() == rows.select(*DEVICE).distinct().count()


def test_hot_keys_go_on_too(rows):
    hot = HotKeys(rows.select(*DEVICE).distinct().limit(3), 200, 40)
    cut = DAY + 10 * 24 * HOUR
    got, _ = day_by_day([rows.where(F.col("eventTime") < cut), rows.where(F.col("eventTime") >= cut)], hot)
    want = everything(Timeline(rows, hot=NO_HOT_KEYS)).frame()
    names = sorted(want.columns)
    assert rows_of(got, *names) == rows_of(want, *names)


def test_late_rows_change_nothing_and_are_marked(spark):
    login = {"userId": "u1"}
    first = events(spark, (DAY + 5, "login", login), (DAY + 6, "a"))
    second = events(spark, (DAY + 1, "old", {"sn": 9, "userId": "x"}), (DAY + 7, "b", {"sn": 10}))
    third = events(spark, (DAY + 2, "older", {"sn": 11}))
    fourth = events(spark, (DAY + 8, "c", {"sn": 12}))
    got, state = day_by_day([first, second, third, fourth], late="late")
    assert rows_of(got, "eventName", "userId", "n", "late") == [
        ("a", "u1", 2, False), ("b", "u1", 3, False), ("c", "u1", 4, False), ("login", "u1", 1, False),
        ("old", "x", None, True), ("older", None, None, True)]
    assert state.count() == 1


def test_state_needs_one_exchange_of_the_rows(spark, rows):
    _, state = day_by_day([rows])
    line = everything(Timeline(rows, hot=NO_HOT_KEYS, state=state, keep=True))
    text = line.frame()._jdf.queryExecution().executedPlan().toString()
    # the rows with the seeds among them, and the keys of the batch that choose the seeds
    assert text.count("Exchange hashpartitioning(projectId") == 2
    assert text.count("HashAggregate(keys=[projectId") == 2
    assert text.count("Window [") > 3
