"""Physical plans that have to hold at any size."""

import pytest

from checks.fixtures import order_events, track
from footfall.operators import bodies, delivery, dims, sessions
from footfall.operators.timeline import NO_HOT_KEYS
from footfall.plans.rebuild import rebuild_state
from footfall.scratch import new_dir
from footfall.sources.events import scan_events, with_event_date

import __spark_entry__ as entry


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_device_state_needs_one_exchange(spark, sf):
    text = plan(rebuild_state(track(spark, sf), hot=NO_HOT_KEYS))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 2  # forwards once, backwards once


def test_session_table_reuses_the_exchange_of_the_windows(spark, sf):
    text = plan(sessions.sessions_per_device(track(spark, sf)))
    assert text.count("Exchange") == 1
    assert "partial_count" in text


def test_limits_per_device_are_applied_before_the_shuffle(spark, sf):
    rows = track(spark, sf, "projectId", "siteId", "deviceId", "eventTime", "sn")
    lines = plan(delivery.take_oldest(rows, 10)).splitlines()
    limits = [i for i, t in enumerate(lines) if "WindowGroupLimit" in t]
    exchange = next(i for i, t in enumerate(lines) if "Exchange" in t)
    assert min(limits) < exchange < max(limits)


def test_copies_are_combined_before_the_shuffle(spark, sf):
    assert plan(delivery.dedupe_events(track(spark, sf))).count("Aggregate(key") == 2


def test_parsing_reads_json_once_and_only_for_its_events(spark, sf):
    path = new_dir(spark, "stored")
    with_event_date(track(spark, sf)).write.partitionBy("event_date").parquet(path)
    rows = bodies.parse_payment(scan_events(spark, path).where("event_date = DATE'2024-01-05'"), keep=("sn",))
    text = plan(rows)
    assert text.count("from_json(") == 1
    assert "EqualTo(eventName,payment)" in text  # reaches the parquet reader
    assert "PartitionFilters: [isnotnull(event_date" in text
    scan = text[text.index("ReadSchema"):]
    assert scan.startswith("ReadSchema: struct<sn:decimal(20,0),eventName:string,eventBody:string>")


def test_order_lines_need_no_shuffle(spark, sf):
    from footfall.operators import commerce

    path = new_dir(spark, "orders")
    order_events(spark, sf).write.parquet(path)
    rows = commerce.order_table(scan_events(spark, path))
    assert "Exchange" not in plan(commerce.order_products(rows))


def test_fixed_lookups_are_broadcast(spark):
    text = plan(dims.with_device_model(spark.range(10).selectExpr("'x' || id AS deviceCode")))
    assert "BroadcastHashJoin" in text


BATCH = sorted(n for n in entry.queries() if not n.startswith(("str", "snk")))


@pytest.mark.parametrize("name", BATCH)
def test_batch_queries_stay_in_the_jvm_and_spread(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for word in ("Python", "Pandas", "SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
