"""Streams give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import track
from footfall.operators import context as batch_context
from footfall.operators import identity, sessions as batch_sessions
from footfall.operators.filters import not_opted_out, sample_events
from footfall.operators.timeline import Timeline
from footfall.scratch import new_dir
from footfall.sources import sinks
from footfall.sources.events import scan_events, stream_events
from footfall.streaming import context, flush, sessions, triggers
from tests.conftest import rows_of
from tests.helpers import DAY, HOUR, events

NAMES = "projectId siteId deviceId eventTime sn eventName eventBody url title userId userProperty".split()


@pytest.fixture(scope="module")
def files(spark, sf):
    """Track events in three files, cut by time, oldest first."""
    path = new_dir(spark, "source")
    rows = track(spark, sf, *NAMES)
    for i, (low, high) in enumerate(((0, 8), (8, 20), (20, 400))):
        part = rows.where(F.col("eventTime").between(DAY + low * 24 * HOUR, DAY + high * 24 * HOUR - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def table(spark, files):
    return scan_events(spark, files).persist()


def source(spark, files):
    return stream_events(spark, files, files_per_trigger=1)


def test_session_windows(spark, files, table):
    rows = sessions.stream_sessions(source(spark, files))
    got = triggers.run_available(rows, new_dir(spark, "s"), "complete")
    want = batch_sessions.sessions_per_device(table, triggers=False)
    names = ["siteId", "deviceId", "seStartTime", "sessionId", "last_event", "n_events"]
    assert rows_of(got, *names) == rows_of(want, *names)


def test_session_windows_on_a_plain_table(table):
    got = sessions.stream_sessions(table)
    want = batch_sessions.sessions_per_device(table, triggers=False)
    assert rows_of(got, "deviceId", "seStartTime", "n_events") == rows_of(want, "deviceId", "seStartTime", "n_events")


def stitched(spark, stream, restarts, **rule):
    path = new_dir(spark, "sessions")
    start = sessions.stream_sessions_with_triggers if restarts else sessions.stream_stitched_sessions
    start(stream, path, new_dir(spark, "checkpoint"), interval_s=-1, **rule).awaitTermination()
    return sessions.read_sessions(spark, path)


@pytest.mark.parametrize("restarts", [False, True])
def test_stitched_sessions(spark, files, table, restarts):
    got = stitched(spark, source(spark, files), restarts)
    want = batch_sessions.sessions_per_device(table, triggers=restarts)
    names = ["siteId", "deviceId", "seStartTime", "sessionId", "last_event", "n_events"]
    assert rows_of(got, *names) == rows_of(want, *names)


@pytest.mark.parametrize("restarts", [False, True])
def test_shuffled_arrival_equals_the_batch(spark, table, restarts):
    """Rows dealt to four epochs by a hash of their number, so that most of them are late."""
    path, want = new_dir(spark, "sessions"), batch_sessions.sessions_per_device(table, timeout_s=6 * 3600, triggers=restarts)
    body = sessions.continue_sessions(path, 6 * 3600, triggers=restarts)
    for epoch in (0, 1, 1, 2, 3):  # one is replayed
        body(table.where(F.pmod(F.xxhash64("sn"), F.lit(4)) == epoch), epoch)
    names = ["siteId", "deviceId", "seStartTime", "sessionId", "last_event", "n_events"]
    assert rows_of(sessions.read_sessions(spark, path), *names) == rows_of(want, *names)


def test_a_late_event_joins_two_sessions_and_a_late_restart_cuts_one(spark):
    path = new_dir(spark, "sessions")
    body = sessions.continue_sessions(path, 1800)

    def now():
        rows = sessions.read_sessions(spark, path)
        return rows_of(rows.select(((F.col("seStartTime") - DAY) / 1000).cast("int"), ((F.col("last_event") - DAY) / 1000).cast("int"), "n_events"))

    body(events(spark, (DAY, "a"), (DAY + 60_000, "b"), (DAY + 2_400_000, "c")), 0)
    assert now() == [(0, 60, 2), (2400, 2400, 1)]
    body(events(spark, (DAY + 1_000_000, "d", {"sn": 9})), 1)
    assert now() == [(0, 2400, 4)]
    body(events(spark, (DAY + 30_000, "openChannel", {"sn": 10})), 2)
    assert now() == [(0, 0, 1), (30, 2400, 4)]
    body(events(spark, (DAY + 40_000, "e", {"sn": 11}), (DAY + 86_400_000, "next", {"sn": 12})), 3)
    assert now() == [(0, 0, 1), (30, 2400, 5), (86400, 86400, 1)]
    # the day before is not opened for the next day's events
    files = sessions._tables(spark, path)[0].versions(spark.sql("SELECT 19724 AS day")).inputFiles()
    assert len(files) == 1


def test_context(spark, files, table):
    path = new_dir(spark, "c")
    context.stream_context(source(spark, files), path, new_dir(spark, "checkpoint"), -1).awaitTermination()
    got = context.read_context(spark, path)
    line = batch_context.page_context(batch_context.attribute_campaign(Timeline(table)))
    line = identity.carry_user_property(identity.carry_user(identity.carry_registration(line)))
    names = ["deviceId", "sn", "url", "title", "referrer", "utm", "pushContent", "userId", "userProperty", "registrationID"]
    assert rows_of(got, *names) == rows_of(line.frame(), *names)
    assert got.where("late").count() == 0


def test_context_survives_a_replay_and_compaction(spark, files, table, monkeypatch):
    monkeypatch.setattr(context, "COMPACT", 2)
    path = new_dir(spark, "c")
    body = context.continue_context(path)
    parts = [table.where(F.col("eventTime").between(DAY + a * 24 * HOUR, DAY + b * 24 * HOUR - 1)) for a, b in ((0, 8), (8, 20), (20, 400))]
    for epoch in (0, 1, 1, 2, 2):
        body(parts[epoch], epoch)
    line = identity.carry_user(batch_context.page_context(batch_context.attribute_campaign(Timeline(table)))).frame()
    names = ["deviceId", "sn", "url", "referrer", "utm", "userId"]
    assert rows_of(context.read_context(spark, path), *names) == rows_of(line, *names)
    assert context._state_table(spark, path).read().count() == table.select("projectId", "siteId", "deviceId").distinct().count()


def test_late_events_are_kept_and_marked(spark):
    path = new_dir(spark, "c")
    body = context.continue_context(path)
    login = {"userId": "u1"}
    body(events(spark, (DAY + 5, "login", login), (DAY + 6, "a")), 0)
    body(events(spark, (DAY + 1, "old", {"sn": 9}), (DAY + 7, "b", {"sn": 10})), 1)
    assert rows_of(context.read_context(spark, path), "eventName", "userId", "late") == [
        ("a", "u1", False), ("b", "u1", False), ("login", "u1", False), ("old", None, True)]


def test_dedupe(spark, table):
    path = new_dir(spark, "source")
    for _ in range(3):
        table.coalesce(1).write.mode("append").parquet(path)
    rows = sessions.stream_dedupe(source(spark, path))
    got = triggers.run_available(rows, new_dir(spark, "d"))
    assert rows_of(got, "deviceId", "sn", "eventName") == rows_of(table, "deviceId", "sn", "eventName")


@pytest.fixture(scope="module")
def disordered(spark):
    """Three files: newer events first, a device 400 days ahead, then older events of others."""
    path = new_dir(spark, "source")
    parts = (
        events(spark, (DAY + 9 * HOUR, "a"), (DAY + 9 * HOUR + 5, "b")),
        events(spark, (DAY + 400 * 24 * HOUR, "c"), (4_000_000_000_000, "d"), (10**17, "e"), deviceId="ahead"),
        events(spark, (DAY + 1, "f", {"sn": 7}), (DAY + HOUR, "g", {"sn": 8}), (DAY + 9 * HOUR + 9, "h", {"sn": 9})).unionByName(
            events(spark, (DAY + 2, "i"), (DAY + 3, "j"), deviceId="other")),
    )
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return path


_SESSION = ["deviceId", "seStartTime", "sessionId", "last_event", "n_events"]


@pytest.mark.parametrize("restarts", [False, True])
def test_late_and_misclocked_events_are_placed(spark, disordered, restarts):
    stored = scan_events(spark, disordered).where("eventTime < 10000000000000000")
    stream = source(spark, disordered).where("eventTime < 10000000000000000")
    want = batch_sessions.sessions_per_device(stored, triggers=restarts)
    assert rows_of(stitched(spark, stream, restarts), *_SESSION) == rows_of(want, *_SESSION)


def test_windows_are_put_right(spark, disordered):
    stored = scan_events(spark, disordered).where("eventTime < 10000000000000000")
    stream = source(spark, disordered).where("eventTime < 10000000000000000")
    rows = triggers.run_available(sessions.stream_sessions(stream, ahead="1000 days"), new_dir(spark, "s"))
    want = batch_sessions.sessions_per_device(stored, triggers=False)
    assert rows_of(rows, *_SESSION) != rows_of(want, *_SESSION)
    got = sessions.corrected_sessions(rows, stored, triggers=False)
    assert rows_of(got, *_SESSION) == rows_of(want, *_SESSION)


def test_dedupe_loses_nothing_but_copies(spark, disordered):
    got = triggers.run_available(sessions.stream_dedupe(source(spark, disordered)), new_dir(spark, "d"))
    assert sorted(r.eventName for r in got.collect()) == list("abcdefghij")


def test_flush_survives_a_replay(spark, files, table):
    out, requests, sent = new_dir(spark, "events"), new_dir(spark, "requests"), []
    for _ in range(2):  # a lost checkpoint: everything comes again, under the same epochs
        query = (
            source(spark, files).writeStream
            .foreachBatch(flush.flush_to(out, requests, 7, lambda df, epoch: sent.append((epoch, df.count()))))
            .option("checkpointLocation", new_dir(spark, "checkpoint"))
            .trigger(**triggers.trigger_from_interval(-1)).start()
        )
        query.awaitTermination()
    assert rows_of(sinks.read_events(spark, out), "deviceId", "sn") == rows_of(table, "deviceId", "sn")
    stored = spark.read.parquet(requests)
    assert stored.agg(F.sum("n_events"), F.max("n_events")).first() == (table.count(), 7)
    assert sent[:3] == sent[3:]


def test_fan_out_stream(spark, files, table):
    new, old = new_dir(spark, "new"), new_dir(spark, "old")
    flush.stream_fan_out(source(spark, files), new, old, new_dir(spark, "checkpoint"), interval_s=-1).awaitTermination()
    assert spark.read.parquet(new).count() == table.count()
    skipped = table.where("eventName IN ('jPush', 'initJPush', 'openChannel')").count()
    assert spark.read.parquet(old).count() == table.count() - skipped


def test_fan_out_counts_visits_without_the_history(spark, table):
    from footfall.plans.rebuild import legacy_table
    from footfall.sources.sinks import fan_out

    new, old = new_dir(spark, "new"), new_dir(spark, "old")
    out = table.select("projectId", "siteId", "deviceId").distinct().orderBy("deviceId").limit(2)
    cuts = [0, DAY + 8 * 24 * HOUR + 7 * HOUR, DAY + 20 * 24 * HOUR, 10**14]
    parts = [table.where(F.col("eventTime").between(a, b - 1)) for a, b in zip(cuts, cuts[1:])]
    for epoch in (0, 1, 1, 2):
        fan_out(parts[epoch], new, old, epoch, opted_out=out, rate=60)
    kept = sample_events(not_opted_out(table, out), 60)
    names = ["idsite", "_id", "cdt", "e_a", "cvar", "new_visit", "_idvc", "_viewts", "_idts"]
    assert rows_of(spark.read.parquet(old), *names) == rows_of(legacy_table(kept), *names)
    assert spark.read.parquet(new).count() == table.count()


def test_users_are_attached_over_the_edge_of_runs(spark, table):
    cuts = [0, DAY + 8 * 24 * HOUR + 7 * HOUR, DAY + 20 * 24 * HOUR, 10**14]
    held, settled = None, []
    for a, b in zip(cuts, cuts[1:]):
        part = table.where(F.col("eventTime").between(a, b - 1))
        done, held = identity.backfill_between(part, held, 36_000)
        settled.append(done)
    got = settled[0].unionByName(settled[1]).unionByName(settled[2]).unionByName(held)
    want = identity.backfill_user(table, 36_000)
    assert rows_of(got, "deviceId", "sn", "userId") == rows_of(want, "deviceId", "sn", "userId")
    assert 0 < held.count() < table.count() / 2
    done, rest = identity.backfill_between(table.limit(0), held, 36_000, until_ms=10**14)
    assert rest.isEmpty() and done.count() == held.count()


def test_default_source_is_bounded(spark, files, table):
    rows = stream_events(spark, files)
    assert triggers.run_available(rows, new_dir(spark, "b")).count() == table.count()


def test_triggers():
    assert triggers.trigger_from_interval(20) == {"processingTime": "20000 milliseconds"}
    assert triggers.trigger_from_interval(0) == {"processingTime": "0 seconds"}
    assert triggers.trigger_from_interval(-1) == {"availableNow": True}


def test_late_users_are_attached_in_the_range_asked_for(spark):
    rows = events(spark, (DAY, "a"), (DAY + 10, "b"), (DAY + 30, "c"), (DAY + 40, "login", {"userId": "u"}))
    got = flush.late_user_attach(rows, DAY + 5, DAY + 35)
    assert rows_of(got, "eventName", "userId") == [("b", "u"), ("c", "u")]
    assert flush.late_user_attach(rows, DAY + 5, DAY + 35, horizon_s=0).count() == 0
