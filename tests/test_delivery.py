from pyspark.sql import functions as F

from checks.fixtures import track
from footfall.operators import delivery
from footfall.schema import SERIAL, SERIAL_MAX
from footfall.scratch import new_dir
from footfall.sources import sinks
from footfall.sources.events import split_untimed, with_event_date
from tests.conftest import rows_of
from tests.helpers import DAY, column, events


def test_missing_serial_numbers_go_on_from_the_last_and_wrap(spark):
    def numbers(*given):
        rows = events(spark, *[(DAY + i, "a", {"sn": n}) for i, n in enumerate(given)])
        out = delivery.assign_sn(rows, order=("eventTime",))
        assert out.schema["sn"].dataType == SERIAL
        return [int(r.sn) for r in out.orderBy("eventTime").collect()]

    assert numbers(100, 101, None, None) == [100, 101, 102, 103]
    assert numbers(None, None, 7, None) == [1, 2, 7, 8]
    assert numbers(SERIAL_MAX - 1, None, None, None) == [SERIAL_MAX - 1, SERIAL_MAX, 1, 2]


def test_the_copy_that_knows_the_user_stays(spark):
    rows = events(spark, (DAY, "a", {"sn": 1}), (DAY, "a", {"sn": 1, "userId": "u"}), (DAY, "a", {"sn": 1}))
    assert [r.userId for r in delivery.dedupe_events(rows).collect()] == ["u"]


def test_a_time_outside_the_calendar_has_no_day(spark):
    rows = events(spark, (2**62, "a"), (DAY, "b"), (None, "c"))
    got = {r.eventName: r.event_date for r in with_event_date(rows).collect()}
    assert got["a"] is None and got["c"] is None and str(got["b"]) == "2024-01-01"


def test_one_path_for_any_number_of_oldest(spark):
    rows = events(spark, *[(DAY + i, "a") for i in range(5)])
    few, many = delivery.take_oldest(rows, 10), delivery.take_oldest(rows, 5000)
    assert few.schema == many.schema and rows_of(few) == rows_of(many)
    assert "WindowGroupLimit" in many._jdf.queryExecution().toString()


def test_order_takes_a_missing_number_as_zero(spark):
    rows = events(spark, (DAY + 1, "c", {"sn": 1}), (DAY, "b", {"sn": 5}), (DAY, "a", {"sn": None}))
    assert [r.eventName for r in delivery.order_v2(rows).collect()] == ["a", "b", "c"]


def test_legacy_order_puts_rows_without_a_number_last(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:01", None, "c"), ("2024-01-01 00:00:00", None, "b"),
         ("2024-01-01 00:00:00", '{"5":["systemvariable","{Lifetime_seq:9}"]}', "a")], "cdt STRING, cvar STRING, n STRING")
    assert [r.n for r in delivery.order_v1(df).collect()] == ["a", "b", "c"]


def test_take_oldest_tells_whether_more_wait(spark):
    rows = events(spark, *[(DAY + i, "a") for i in range(5)], (DAY, "a", {"deviceId": "d2"}))
    got = rows_of(delivery.take_oldest(rows, 4), "deviceId", "eventTime", "has_more")
    assert got == [("d1", DAY + i, True) for i in range(4)] + [("d2", DAY, False)]
    assert {r.has_more for r in delivery.take_oldest(rows, 5).collect()} == {False}


def test_a_full_queue_refuses_the_newest(spark, sf):
    rows = track(spark, sf, "event_id", "projectId", "siteId", "deviceId", "eventTime", "sn")
    kept = delivery.cap_per_device(rows, 3)
    assert kept.groupBy("siteId", "deviceId").count().agg(F.max("count")).first()[0] == 3
    dropped = rows.join(kept, "event_id", "left_anti")
    newest = kept.groupBy("deviceId").agg(F.max("eventTime").alias("t"))
    assert dropped.join(newest, "deviceId").where("eventTime < t").count() == 0
    # above the size Spark limits groups for
    assert delivery.cap_per_device(rows, 2000).count() == rows.count()


def test_dedupe_keeps_events_that_only_share_a_missing_number(spark):
    rows = events(
        spark, (DAY, "a", {"sn": None}), (DAY, "a", {"sn": None}), (DAY, "b", {"sn": None}),
        (DAY, "c", {"sn": 1}), (DAY, "c", {"sn": 1}), (DAY + 1, "c", {"sn": 1}))
    assert column(delivery.dedupe_events(rows), "eventName", "eventName") == ["a", "b", "c", "c"]


def test_many_copies_of_one_event(spark):
    rows = events(spark, (DAY, "a"), (DAY + 1, "b"))
    copies = rows.crossJoin(spark.range(2000)).drop("id")
    assert delivery.dedupe_events(copies).count() == 2


def stored(spark, path):
    return rows_of(sinks.read_events(spark, path), "eventTime", "eventName")


def test_replays_and_resends_end_in_the_same_table(spark):
    path = new_dir(spark, "t")
    day = 86_400_000
    first = events(spark, (DAY, "a"), (DAY + day, "b"), (DAY + day, "b", {"sn": 2}))
    second = events(spark, (DAY + day, "b", {"sn": 2}), (DAY + 2 * day, "c", {"sn": 9}))
    want = [(DAY, "a"), (DAY + day, "b"), (DAY + 2 * day, "c")]
    sinks.write_idempotent(first, 0, path)
    sinks.write_idempotent(first, 0, path)
    assert stored(spark, path) == want[:2]
    for epoch in (1, 1, 0, 2):
        sinks.write_idempotent(first if epoch == 0 else second, epoch, path)
        assert stored(spark, path) == want


def test_a_number_that_starts_again_is_not_a_resend(spark):
    path = new_dir(spark, "t")
    sinks.write_idempotent(events(spark, (DAY, "a", {"sn": 1})), 0, path)
    sinks.write_idempotent(events(spark, (DAY + 5, "a", {"sn": 1})), 1, path)
    assert stored(spark, path) == [(DAY, "a"), (DAY + 5, "a")]


def test_empty_batches(spark):
    path = new_dir(spark, "t")
    none = events(spark, (DAY, "a")).where("false")
    sinks.write_idempotent(none, 0, path)
    sinks.write_idempotent(events(spark, (DAY, "a")), 1, path)
    sinks.write_idempotent(none, 2, path)
    assert stored(spark, path) == [(DAY, "a")]


def test_what_a_later_copy_knows_is_kept(spark):
    def batch(**facts):
        return events(spark, (DAY, "a", {"sn": 1, **facts}), (DAY + 86_400_000, "b", {"sn": 2}))

    path = new_dir(spark, "t")
    copies = [batch(), batch(userId="u"), batch(userProperty="p"), batch(), batch(userId="u")]
    for epoch, copy in enumerate(copies):
        sinks.write_idempotent(copy, epoch, path)
    names = ("eventName", "userId", "userProperty", "version")
    want = [("a", "u", "p", 2), ("b", None, None, 0)]
    assert rows_of(sinks.read_events(spark, path), *names) == want
    for epoch in (1, 2, 0):  # replays
        sinks.write_idempotent(copies[epoch], epoch, path)
        assert rows_of(sinks.read_events(spark, path), *names) == want
    table = sinks.event_table(spark, path)
    assert rows_of(table.at(2), "eventName", "userId", "userProperty") == [("a", "u", "p")]
    assert table.at(3) is None or table.at(3).isEmpty()


def test_one_copy_knows_the_user_another_the_property(spark):
    rows = events(spark, (DAY, "a", {"sn": 1, "userId": "u"}), (DAY, "a", {"sn": 1, "userProperty": "p"}), (DAY, "a", {"sn": 1}))
    assert rows_of(delivery.dedupe_events(rows), "userId", "userProperty") == [("u", "p")]


def test_a_batch_opens_the_files_of_its_days_only(spark):
    path = new_dir(spark, "t")
    for epoch in range(3):
        sinks.write_idempotent(events(spark, (DAY + epoch * 86_400_000, "a")), epoch, path)
    table = sinks.event_table(spark, path)
    days = spark.sql("SELECT DATE'2024-01-02' AS d")
    files = table.versions(days).inputFiles()
    assert len(files) == 1 and "__part=2024-01-02" in files[0]
    table.compact(1)
    assert {f.split("/")[-3].split("-")[0] for f in table.versions().inputFiles()} == {"base", "epoch"}
    assert len(table.versions().inputFiles()) == 3
    assert stored(spark, path) == [(DAY + i * 86_400_000, "a") for i in range(3)]


def test_an_epoch_without_a_commit_does_not_exist(spark):
    path = new_dir(spark, "t")
    sinks.write_idempotent(events(spark, (DAY, "a")), 0, path)
    with_event_date(events(spark, (DAY, "lost"))).withColumn("__part", F.lit("2024-01-01")).write.partitionBy("__part").parquet(
        f"{path}/data/epoch-1-broken")
    assert stored(spark, path) == [(DAY, "a")]


def test_oldest_rows_in_two_steps_are_the_oldest(spark):
    rows = spark.range(0, 40_000, numPartitions=200).selectExpr(
        "'p' AS projectId", "'s' AS siteId", "CASE WHEN id % 9 = 0 THEN 'b' ELSE 'a' END AS deviceId",
        "CAST(xxhash64(id) % 1000000 AS BIGINT) AS eventTime", "CAST(id AS DECIMAL(20,0)) AS sn")
    got = delivery.take_oldest(rows, 50)
    assert got.count() == 100 and got.where("NOT has_more").isEmpty()
    want = rows.orderBy("eventTime", "sn").where("deviceId = 'a'").limit(50)
    assert rows_of(got.where("deviceId = 'a'"), "eventTime", "sn") == rows_of(want, "eventTime", "sn")
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("WindowGroupLimit" in t for t in lines) == 4  # before and after either shuffle


def test_state_over_a_device_store_needs_no_exchange(spark, sf):
    from footfall.operators.timeline import NO_HOT_KEYS
    from footfall.plans.rebuild import rebuild_state
    from footfall.sources.stored import DeviceStore

    rows = track(spark, sf)
    store = DeviceStore(spark, "stored_for_test", new_dir(spark, "stored"), 4)
    cut = DAY + 12 * 86_400_000
    for batch, part in enumerate((rows.where(F.col("eventTime") < cut), rows.where(F.col("eventTime") >= cut))):
        store.append(part, batch, busy=3)
    assert store.hot() is NO_HOT_KEYS
    got = rebuild_state(store.scan(), hot=store.hot())
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in rebuild_state(store.scan("2024-01-03", "2024-01-08"), hot=store.hot())._jdf.queryExecution().executedPlan().toString()
    names = ["deviceId", "sn", "seStartTime", "url", "utm", "userId"]
    assert rows_of(got, *names) == rows_of(rebuild_state(rows), *names)
    # what is known of busy devices: exact sums of the days on which they were
    counts = rows.groupBy("deviceId", F.floor(F.col("eventTime") / 86_400_000)).count().where("count >= 3")
    busiest = counts.groupBy("deviceId").agg(F.sum("count").alias("n")).orderBy(F.desc("n")).first()
    hot = store.hot(floor=busiest.n)
    assert hot.rows >= busiest.n and busiest.deviceId in [r.deviceId for r in hot.keys.collect()]
    assert rows_of(rebuild_state(store.scan(), hot=hot), *names) == rows_of(rebuild_state(rows), *names)
    spark.sql("DROP TABLE stored_for_test")


def test_unpaired_rows(spark):
    from footfall.operators.bridge import unpaired

    make = lambda *rows: spark.createDataFrame(list(rows), "k STRING, at INT, more STRING")
    left = make(("a", 1, "x"), ("a", 1, "y"), ("a", 1, "z"), (None, 2, "n"), ("b", 5, "q"))
    right = make(("a", 1, "w"), (None, 2, "m"), ("c", 7, "r"), ("c", 7, "s"))
    got = unpaired(left, right, ["k", "at"], ["more"])
    assert rows_of(got, "protocol", "k", "at", "more") == sorted(
        [("v1", "a", 1, "y"), ("v1", "a", 1, "z"), ("v1", "b", 5, "q"), ("v2", "c", 7, "r"), ("v2", "c", 7, "s")])
    assert unpaired(left, left, ["k", "at"]).isEmpty()


def test_dates_and_quarantine(spark):
    rows = events(spark, (DAY - 1, "a"), (DAY, "b"), (None, "c"))
    good, bad = split_untimed(rows)
    assert [str(d) for d in column(with_event_date(good), "event_date")] == ["2023-12-31", "2024-01-01"]
    assert column(bad, "eventName") == ["c"]
