"""Hot keys must give the same rows as plain windows."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import track
from footfall.operators import context, delivery, identity, sessions
from footfall.operators.timeline import HotKeys, NO_HOT_KEYS, SLICE, Timeline, find_hot
from footfall.plans.rebuild import legacy_table, rebuild_state
from footfall.schema import DEVICE
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def skewed(spark, sf):
    """Half of all events on one device, a tenth on a device without an id."""
    rows = track(spark, sf, "event_id", "k", *(
        "projectId siteId deviceId eventTime sn eventName eventBody url title userId userProperty".split()))
    pick = F.col("event_id") % 10
    one = F.col("event_id") % 2 == 0
    rows = rows.withColumns({
        "deviceId": F.when(one, "bot").when(pick == 1, F.lit(None)).otherwise(F.col("deviceId")),
        "siteId": F.when(one, "s1").otherwise(F.col("siteId")),
    })
    return rows.persist()


@pytest.fixture(scope="module")
def hot(skewed):
    found = find_hot(skewed, floor=40)
    names = {r["deviceId"] for r in found.keys.collect()}
    assert "bot" in names and None in names and len(names) < 10
    return found


OPERATORS = {
    "rebuild": lambda rows, hot: rebuild_state(rows, horizon_s=7200, hot=hot),
    "v1": lambda rows, hot: sessions.visit_counters(sessions.sessionize_v1(Timeline(rows, hot=hot))).frame(),
    "visit_vars": lambda rows, hot: sessions.visit_vars_scope(
        sessions.sessionize_v2(Timeline(rows.withColumn(
            "visitVars", F.when(F.col("k") % 4 == 0, F.concat(F.lit("v"), F.col("k").cast("string")))), hot=hot))).frame(),
    "legacy": lambda rows, hot: legacy_table(rows, hot=hot),
    "backfill": lambda rows, hot: identity.backfill_user(rows, 36_000, hot=hot),
    "batch": lambda rows, hot: delivery.batch_index(rows, 7, hot=hot),
    "legacy_url": lambda rows, hot: context.legacy_page_url(rows, F.lit("app"), hot=hot),
    "assign_sn": lambda rows, hot: delivery.assign_sn(
        rows.withColumn("sn", F.when(F.col("k") > 50, F.col("sn"))), order=("eventTime", "event_id"), hot=hot),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hot_keys_change_nothing(skewed, hot, name):
    run = OPERATORS[name]
    plain = run(skewed, NO_HOT_KEYS)
    split = run(skewed, hot)
    columns = sorted(plain.columns)
    assert rows_of(split, *columns) == rows_of(plain, *columns)


def test_hot_keys_are_looked_up_not_compared_with_every_row(skewed, hot):
    text = sessions.sessionize_v2(skewed, hot=hot)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_slices_are_even_and_bounded(skewed, hot):
    line = Timeline(skewed, hot=HotKeys(hot.keys, hot.rows, 40))
    sizes = [r["count"] for r in line._hot.groupBy(*DEVICE, SLICE).count().collect()]
    assert len(sizes) > 5
    assert sum(sizes) == hot.rows
    assert max(sizes) < 4 * 40
    # a summary row per slice and key
    assert len(sizes) <= line.hot_keys.slices + hot.keys.count()


def test_no_hot_keys_below_the_floor(skewed):
    assert not find_hot(skewed)


def test_the_limit_does_not_grow_with_the_table(skewed):
    few = find_hot(skewed, floor=40)
    more = find_hot(skewed.unionByName(skewed.withColumn("deviceId", F.concat("deviceId", F.lit("-2")))), floor=40)
    assert more.keys.count() >= few.keys.count() and more.slice_rows == few.slice_rows


def test_empty_input(skewed):
    assert rebuild_state(skewed.where("false")).count() == 0
