"""Streams whose running values are kept in Spark's state, the streaming sink, and the life of a query."""

import json
import os
import time
from datetime import timedelta

import pytest
from builders import NOON, action, action_table, ad_line, line_table
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from shoptrail.operators import ads, buckets, funnel, sessions
from shoptrail.params import TaskParams
from shoptrail.sinks.row_files import RowFilesSource, RowFilesWriter, manifests
from shoptrail.sinks.tables import replace_bucketed
from shoptrail.sources.ad_log import file_lines, parse_ad_lines
from shoptrail.sources.tables import visit_actions
from shoptrail.streaming import stateful
from shoptrail.streaming.lifecycle import ProgressTotals, stop_between_batches

ONCE = {"availableNow": True}


def minutes(n):
    return NOON + timedelta(minutes=n)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def add(lines):
        name = f"piece-{len(os.listdir(folder))}"
        (folder / name).write_text("\n".join(lines) + "\n")
        stamp = time.time() + len(os.listdir(folder))
        os.utime(folder / name, (stamp, stamp))

    return folder, add


def clicks_of(spark, folder):
    return parse_ad_lines(file_lines(spark, str(folder), files_per_trigger=1))


def clicks_in(spark, *pieces):
    return parse_ad_lines(line_table(spark, [line for p in pieces for line in p]))


class Latest:
    """A sink that keeps the last value of each key, and all rows in order."""

    def __init__(self):
        self.held, self.seen = {}, []

    def __call__(self, batch, batch_id):
        for row in batch.collect():
            self.held[tuple(row)[:-1]] = row[-1]
            self.seen.append(tuple(row))

    def rows(self):
        return sorted((*k, v) for k, v in self.held.items())


def test_totals_state_falls_and_late_clicks_are_counted(spark, inbox, tmp_path):
    folder, add = inbox
    first = [ad_line(user=u, ad=u % 3) for u in range(9)] * 2
    days_later = [ad_line(ad=1, at=NOON + timedelta(days=3))]
    late = [ad_line(ad=1)] * 5 + [ad_line(ad=2, at=NOON + timedelta(days=3))]
    for piece in (first, days_later, days_later, late):  # a watermark holds from the batch after the next on
        add(piece)
    sink = Latest()
    query = stateful.start(stateful.running_totals(clicks_of(spark, folder)), "update", str(tmp_path / "cp"), sink, ONCE)
    query.awaitTermination()
    assert sink.rows() == rows(ads.city_totals(clicks_in(spark, first, days_later, days_later, late[-1:])))
    state = stateful.state_rows(query)
    assert max(state) >= 3 and state[-1] == 2  # the first day's totals are gone
    assert stateful.late_rows(query) >= 1  # late clicks are combined per key before they meet the state
    assert any(name.startswith("rocksdb") for o in query.recentProgress[0]["stateOperators"] for name in o["customMetrics"])


def test_the_sessions_settings_come_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with stateful.state_store(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


def test_totals_go_on_after_a_batch_that_failed(spark, inbox, tmp_path):
    """The second batch fails once, after its rows were written; its checkpoint has changelog files."""
    folder, add = inbox
    pieces = [[ad_line(ad=n % 2)] * (n + 1) for n in range(3)]
    for piece in pieces:
        add(piece)
    sink, failures = Latest(), []

    def write(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("once")

    def begin():
        return stateful.start(stateful.running_totals(clicks_of(spark, folder)), "update", str(tmp_path / "cp"), write, ONCE)

    with pytest.raises(StreamingQueryException):
        begin().awaitTermination()
    begin().awaitTermination()
    assert failures == [1] and sink.rows() == rows(ads.city_totals(clicks_in(spark, *pieces)))
    assert list((tmp_path / "cp" / "state").rglob("*.changelog"))


def test_minutes_and_hours_come_once_and_are_whole(spark, inbox, tmp_path):
    folder, add = inbox
    pieces = [[ad_line(at=minutes(0))] * 3 + [ad_line(at=minutes(1), ad=2)], [ad_line(at=minutes(30))], [ad_line(at=minutes(300))]]
    for piece in pieces:
        add(piece)
    trend, hours = [], []
    for name, result, out in (("m", stateful.minute_counts, trend), ("h", stateful.sliding_hours, hours)):
        write = lambda batch, _, out=out: out.extend(tuple(r) for r in batch.collect())
        stateful.start(result(clicks_of(spark, folder)), "append", str(tmp_path / name), write, ONCE).awaitTermination()
    assert sorted(trend) == rows(ads.minute_trend(clicks_in(spark, *pieces[:2])))
    found = {(r[0][11:16], r[2]): r[3] for r in hours}
    assert len(found) == len(hours)
    assert (found["11:01", 1], found["11:31", 1], found["12:00", 1], found["12:01", 1], found["12:30", 1]) == (3, 4, 4, 1, 1)
    assert found["12:01", 2] == 1 and ("12:02", 2) not in found and ("12:31", 1) not in found


def test_a_late_click_of_an_open_hour_still_counts(spark, inbox, tmp_path):
    folder, add = inbox
    for piece in ([ad_line(at=minutes(100))], [ad_line(at=minutes(50))], [ad_line(at=minutes(400))]):
        add(piece)
    out = []
    stateful.start(stateful.minute_counts(clicks_of(spark, folder)), "append", str(tmp_path / "m"), lambda b, _: out.extend(b.collect()), ONCE).awaitTermination()
    assert {(r.hour, r.minute): r.clickCount for r in out} == {("12", "50"): 1, ("13", "40"): 1}


def test_a_ban_comes_once_and_old_days_leave_the_state(spark, inbox, tmp_path):
    folder, add = inbox
    for piece in (
        [ad_line(user=1)] * 2 + [ad_line(user=2)] * 3 + [ad_line(user=3, ad=a) for a in range(6)],
        [ad_line(user=1)] + [ad_line(user=2)] * 9,  # user 1 reaches three clicks now, user 2 is banned already
        [ad_line(user=3, ad=1, at=NOON + timedelta(days=5))],
        [ad_line(user=4, at=NOON + timedelta(days=9))],  # the watermark passes user 3's days
    ):
        add(piece)
    out = []
    bans = stateful.ban_users(clicks_of(spark, folder), above=2)
    query = stateful.start(bans, "update", str(tmp_path / "cp"), lambda b, n: out.extend((n, *r) for r in b.collect()), ONCE)
    query.awaitTermination()
    assert sorted(out) == [(0, 2, 1, 3), (1, 1, 1, 3)]
    # what is left: two bans, user 4's count, its timer, and what Spark keeps of them
    state = stateful.state_rows(query)
    assert state[-1] < max(state)


class CountedState:
    """State of one user in memory, with the calls that reach it; each is a message to the JVM."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, {}, set()

    def getValueState(self, name, schema):
        return CountedValue(self, name)

    def getMapState(self, name, key, value):
        return CountedMap(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class CountedValue:
    def __init__(self, state, name):
        self.state, self.name = state, name

    def get(self):
        self.state.calls += 1
        return self.state.values.get(self.name)

    def exists(self):
        return self.get() is not None

    def update(self, value):
        self.state.calls += 1
        self.state.values[self.name] = value

    def clear(self):
        self.state.calls += 1
        self.state.values.pop(self.name, None)


class CountedMap:
    def __init__(self, state):
        self.state, self.held = state, {}

    def containsKey(self, key):
        self.state.calls += 1
        return key in self.held

    def updateValue(self, key, value):
        self.state.calls += 1
        self.held[key] = value


def test_calls_to_the_state_do_not_grow_with_a_users_clicks():
    state, passed, day_ms = CountedState(), type("Passed", (), {}), 24 * 3600 * 1000
    bans = stateful._Bans(2)
    bans.init(state)
    clicks = [Row(userid=1, day=day, adid=ad, clicks=1) for day in range(40) for ad in range(5)]
    assert list(bans.handleInputRows((1,), iter(clicks), None)) == [] and state.calls <= 4
    # one timer waits for the first day's end; when the watermark has passed more days, they all go at once
    passed.getCurrentWatermarkInMs = passed.getExpiryTimeInMs = staticmethod(lambda: 30 * day_ms)
    assert state.timers == {day_ms}
    state.timers.clear()
    assert list(bans.handleExpiredTimer((1,), passed, passed)) == [] and state.calls <= 8
    assert state.timers == {31 * day_ms}
    # an earlier day that the watermark has not passed moves the timer; the counts of the other days are still there
    assert list(bans.handleInputRows((1,), iter([Row(userid=1, day=29, adid=0, clicks=2)]), None)) == [] and state.timers == {30 * day_ms}
    assert list(bans.handleInputRows((1,), iter([Row(userid=1, day=d, adid=4, clicks=2) for d in (35, 34)]), None)) == [Row(userid=1, adid=4, clickCount=3)]
    assert state.timers == set() and list(bans.handleInputRows((1,), iter(clicks), None)) == []


def test_a_query_stopped_between_batches_goes_on(spark, inbox, tmp_path):
    folder, add = inbox
    totals, sink = ProgressTotals(), Latest()
    spark.streams.addListener(totals)
    try:
        pieces = [[ad_line(ad=n), "broken"] for n in range(4)]
        for n in (0, 2):
            add(pieces[n])
            add(pieces[n + 1])
            lines = file_lines(spark, str(folder), files_per_trigger=1)
            result = stateful.running_totals(parse_ad_lines(lines, observe_as="ad_lines"))
            query = stateful.start(result, "update", str(tmp_path / "cp"), sink, {"processingTime": "1 second"})
            query.processAllAvailable()
            assert stop_between_batches(query, timeout=60) and not query.isActive and query.exception() is None
        until = time.time() + 20
        while time.time() < until and not (totals.of(query).rows == 8 and totals.of(query).ended):
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    seen = totals.of(query)
    assert sink.rows() == rows(ads.city_totals(clicks_in(spark, *pieces)))
    assert (seen.rows, seen.late_rows, seen.ended, seen.error) == (8, 0, True, None) and seen.batches >= 4
    assert seen.metrics["ad_lines"] == {"lines": 8, "malformed": 4} and seen.state_rows == 4
    assert stop_between_batches(query)


# --- the streaming sink ---------------------------------------------------------------------

KINDS = T.StructType().add("k", "string").add("v", "long")


def read_files(spark, path):
    spark.dataSource.register(RowFilesSource)
    return spark.read.format("row_files").option("path", str(path)).schema(KINDS).load()


def test_row_files_of_a_task_that_ran_twice_are_read_once(spark, tmp_path):
    writer = RowFilesWriter(str(tmp_path), KINDS)
    lost = writer.write(iter([Row(k="a", v=1)]))  # its message never arrives
    kept = writer.write(iter([Row(k="a", v=1)]))
    other = writer.write(iter([Row(k="b", v=None)] * 3))
    writer.commit([kept, other, writer.write(iter([])), None], 0)
    assert lost.name != kept.name and rows(read_files(spark, tmp_path)) == [("a", 1)] + [("b", None)] * 3
    again = writer.write(iter([Row(k="a", v=1)]))
    writer.commit([again], 0)  # the batch runs again after a crash
    assert rows(read_files(spark, tmp_path)) == [("a", 1)] + [("b", None)] * 3 and not (tmp_path / "rows" / again.name).exists()
    failed = writer.write(iter([Row(k="c", v=1)]))
    writer.abort([failed, None], 1)
    assert not (tmp_path / "rows" / failed.name).exists() and len(manifests(str(tmp_path))) == 1


def test_row_files_without_any_batch(spark, tmp_path):
    assert rows(read_files(spark, tmp_path / "nothing")) == []


def test_row_files_stream_restarts_without_losing_or_repeating(spark, tmp_path):
    spark.dataSource.register(RowFilesSource)
    for n in range(3):
        spark.range(n * 100, n * 100 + 100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(KINDS).parquet(str(tmp_path / "in"))
        query = source.writeStream.format("row_files").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        query.trigger(**ONCE).start().awaitTermination()
    # the last batch's commit is lost, so the batch runs again
    os.remove(max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda f: int(f.name)))
    for hidden in (tmp_path / "cp" / "commits").glob(".*crc"):
        os.remove(hidden)
    source.writeStream.format("row_files").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start().awaitTermination()
    assert sorted(r.v for r in read_files(spark, tmp_path / "out").collect()) == list(range(300))
    listed = [e["name"] for m in manifests(str(tmp_path / "out")) for e in json.loads(open(m).read())]
    assert len(listed) == len(set(listed))


# --- counters and bucketed tables -----------------------------------------------------------


@pytest.mark.parametrize("limits", ["reference", "closed"])
def test_counters_filled_by_a_write_equal_the_aggregation(spark, tmp_path, limits):
    some = spark.range(500).select(F.col("id").alias("session_id"), (F.col("id") % 70).alias("visit_length"), (F.col("id") % 40).alias("step_length"))
    watched, counters = buckets.observed(some, limits)
    watched.write.parquet(str(tmp_path / "rows"))
    assert rows(buckets.counted(spark, counters, limits)) == rows(buckets.bucket_counts(some, limits))


def test_counters_of_no_rows(spark, tmp_path):
    some = spark.range(0).select(F.col("id").alias("visit_length"), F.col("id").alias("step_length"))
    watched, counters = buckets.observed(some)
    watched.write.parquet(str(tmp_path / "rows"))
    assert rows(buckets.ratios_of(buckets.counted(spark, counters), "t")) == rows(buckets.length_ratios(some, "t"))


def test_bucketed_actions_need_no_exchange(spark, tmp_path):
    data = [action(session=f"s{i % 7}", seconds=i, event=i, page_id=i % 5) for i in range(100)]
    params = TaskParams("2024-03-01", "2024-03-01")
    plain = visit_actions(action_table(spark, data), params)
    replace_bucketed(plain, "bucketed_actions", "session_id", "action_time", 4, str(tmp_path / "t"))
    table = spark.read.table("bucketed_actions")
    kept = sessions.session_rollup(table).where("step_length > 14")
    results = {
        "rollup": sessions.session_rollup(table),
        "kept": sessions.of_sessions(table, kept),
        "moves": funnel.page_moves(table, None),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in results.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, (name, plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(results["rollup"]) == rows(sessions.session_rollup(plain))
    assert rows(results["moves"]) == rows(funnel.page_moves(plain))
    assert results["kept"].count() == 2 * 15
    spark.sql("DROP TABLE bucketed_actions")
