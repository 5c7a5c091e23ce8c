"""Streams over pieces of a click log, written one after another in time order."""

import os
import time
from datetime import datetime, timedelta

import pytest
from builders import NOON, ad_line, line_table
from conftest import rows
from shoptrail import schemas
from shoptrail.operators import ads
from shoptrail.sinks.keyed import KeyedTable
from shoptrail.sources.ad_log import file_lines, kafka_lines, parse_ad_lines
from shoptrail.streaming import running
from shoptrail.streaming.ad_job import AdTables, process_batch, start_ad_job

ONCE = {"availableNow": True}
PIECES = [
    # One user clicks one ad 3 times, another twice; a second province starts in piece two.
    [ad_line(user=1)] * 3 + [ad_line(user=2, ad=2)] * 2 + ["broken line"],
    [ad_line(user=1, ad=9)] * 4
    + [ad_line(user=2, ad=2, at=NOON + timedelta(minutes=1))]
    + [ad_line(user=3, province="South", city="Rome", ad=4, at=NOON + timedelta(minutes=2))],
    [ad_line(user=2, ad=2)] + [ad_line(user=3, ad=a, at=NOON + timedelta(minutes=a)) for a in range(1, 6)],
]
BAN_ABOVE = 2


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


def stream(spark, folder):
    return file_lines(spark, str(folder), files_per_trigger=1)


def all_clicks(spark, pieces=PIECES):
    return parse_ad_lines(line_table(spark, [line for p in pieces for line in p]))


def allowed(pieces=PIECES):
    """The lines that count: user 1 is banned after piece one, user 2 after piece two."""
    return [pieces[0], [x for x in pieces[1] if x.split()[3:4] != ["1"]], [x for x in pieces[2] if x.split()[3] == "3"]]


def expect_job_tables(spark, tables):
    counted = all_clicks(spark, allowed())
    assert rows(tables.blacklist.current()) == [(1,), (2,)]
    assert rows(tables.user_counts.current()) == rows(ads.user_daily_counts(counted))
    assert rows(tables.city_totals.current()) == rows(ads.city_totals(counted))
    assert rows(tables.province_top.current()) == rows(ads.province_top_ads(ads.city_totals(counted)))
    assert rows(tables.trend.current()) == rows(ads.minute_trend(counted))


def test_job_bans_from_the_next_batch_on(spark, inbox, tmp_path):
    folder, add = inbox
    for piece in PIECES:
        add(piece)
    tables = AdTables.below(spark, str(tmp_path / "out"))
    query = start_ad_job(stream(spark, folder), tables, str(tmp_path / "cp"), BAN_ABOVE, ONCE)
    query.awaitTermination()
    seen = [p["observedMetrics"]["ad_lines"] for p in query.recentProgress if p["numInputRows"]]
    assert [(s["lines"], s["malformed"]) for s in map(lambda s: s.asDict() if hasattr(s, "asDict") else s, seen)] == [
        (6, 1),
        (6, 0),
        (6, 0),
    ]
    expect_job_tables(spark, tables)


def test_job_goes_on_after_a_restart(spark, inbox, tmp_path):
    folder, add = inbox
    tables = AdTables.below(spark, str(tmp_path / "out"))
    for piece in PIECES:
        add(piece)
        start_ad_job(
            stream(spark, folder), tables, str(tmp_path / "cp"), BAN_ABOVE, ONCE
        ).awaitTermination()
    expect_job_tables(spark, tables)


def test_replayed_batches_change_nothing(spark, tmp_path):
    """A batch may run again after any of its steps."""
    tables = AdTables.below(spark, str(tmp_path / "out"))
    for batch_id, piece in enumerate(PIECES):
        for _ in range(2):
            process_batch(all_clicks(spark, [piece]), batch_id, tables, BAN_ABOVE)
    expect_job_tables(spark, tables)


def test_batches_without_any_click(spark, tmp_path):
    tables = AdTables.below(spark, str(tmp_path / "out"))
    pieces = [["broken line"], PIECES[0], [ad_line(user=1)] * 5, PIECES[1], ["another"], PIECES[2]]
    for batch_id, piece in enumerate(pieces):
        process_batch(all_clicks(spark, [piece]), batch_id, tables, BAN_ABOVE)
    expect_job_tables(spark, tables)


def test_running_totals_equal_the_batch_result(spark, inbox, tmp_path):
    folder, add = inbox
    keys = ("date", "province", "city", "adid")
    totals = KeyedTable(spark, str(tmp_path / "t"), schemas.AD_CITY_TOTALS, "add", keys, "clickCount")
    top = KeyedTable(spark, str(tmp_path / "p"), schemas.AD_PROVINCE_TOP3, "replace_group", ("date", "province"))
    for piece in PIECES:
        add(piece)
        clicks = parse_ad_lines(stream(spark, folder))
        running.start_province_top_ads(clicks, totals, top, str(tmp_path / "cp"), ONCE).awaitTermination()
    expected = ads.city_totals(all_clicks(spark))
    assert rows(totals.current()) == rows(expected)
    assert rows(top.current()) == rows(ads.province_top_ads(expected))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_trend_has_every_click_however_late(spark, inbox, tmp_path, order):
    folder, add = inbox
    keys = ("date", "hour", "minute", "adid")
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.AD_TREND, "add", keys, "clickCount", "date")
    pieces = [PIECES[0], [ad_line(at=NOON + timedelta(hours=40))] * 2, [ad_line(at=NOON + timedelta(seconds=1))]]
    for i in order:
        add(pieces[i])
    running.start_counts(parse_ad_lines(stream(spark, folder)), ads.minute_trend, table, str(tmp_path / "cp"), ONCE).awaitTermination()
    assert rows(table.current()) == rows(ads.minute_trend(all_clicks(spark, pieces)))


def test_sliding_hour(spark):
    lines = [ad_line(at=NOON), ad_line(at=NOON + timedelta(minutes=59)), ad_line(at=NOON + timedelta(minutes=60))]
    got = running.sliding_hours(ads.minute_trend(all_clicks(spark, [lines]))).collect()
    assert len(got) == 120 and {r.windowStart[11:] for r in got if r.clickCount == 2} >= {"12:00:00", "12:01:00"}
    found = {r.windowStart[11:16]: (r.clickCount, r.windowEnd[11:16]) for r in got}
    assert (found["11:01"], found["12:00"], found["12:01"], found["13:00"]) == ((1, "12:01"), (2, "13:00"), (2, "13:01"), (1, "14:00"))


def test_a_new_checkpoint_goes_on_where_the_tables_stand(spark, inbox, tmp_path):
    folder, add = inbox
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.AD_CITY_TOTALS, "add", ("date", "province", "city", "adid"), "clickCount")
    for _ in range(5):
        add([ad_line()] * 10)
    source = parse_ad_lines(stream(spark, folder))
    for _ in range(2):  # the second time there is nothing new
        running.start_counts(source, ads.city_totals, table, str(tmp_path / "cp1"), ONCE).awaitTermination()
        assert [r.clickCount for r in table.current().collect()] == [50]
    second = tmp_path / "second"
    second.mkdir()
    for i in range(3):
        (second / f"p{i}").write_text("\n".join([ad_line()] * 10) + "\n")
    later = parse_ad_lines(stream(spark, second))
    running.start_counts(later, ads.city_totals, table, str(tmp_path / "cp2"), ONCE).awaitTermination()
    assert [r.clickCount for r in table.current().collect()] == [80]
    with pytest.raises(ValueError, match="newer checkpoint"):
        running.start_counts(source, ads.city_totals, table, str(tmp_path / "cp1"), ONCE)


def test_the_blacklist_outlives_the_checkpoint(spark, inbox, tmp_path):
    folder, add = inbox
    tables = AdTables.below(spark, str(tmp_path / "out"))
    for n, piece in enumerate(PIECES):
        part = folder.parent / f"in{n}"
        part.mkdir()
        (part / "lines").write_text("\n".join(piece) + "\n")
        start_ad_job(stream(spark, part), tables, str(tmp_path / f"cp{n}"), BAN_ABOVE, ONCE).awaitTermination()
    expect_job_tables(spark, tables)


def keyed(spark, path, rule, keys, value="v", **more):
    from pyspark.sql import types as T

    schema = T.StructType().add("k", "string").add("g", "string").add("v", "long")
    return KeyedTable(spark, str(path), schema, rule, keys, value, **more)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, g string, v bigint")


RULES = [
    ("add", ("k", "g"), "v", [("a", "x", 5), ("b", "x", 2), ("c", "y", 4)]),
    ("replace", ("k", "g"), "v", [("a", "x", 4), ("b", "x", 2), ("c", "y", 4)]),
    ("replace_group", ("g",), None, [("a", "x", 4), ("c", "y", 4)]),
]


@pytest.mark.parametrize("rule, keys, value, expected", RULES)
@pytest.mark.parametrize("by_day", [True, False])
def test_rules_of_keyed_tables(spark, tmp_path, rule, keys, value, expected, by_day):
    table = keyed(spark, tmp_path, rule, keys, value, partition="g" if by_day else None)
    assert rows(table.current()) == []
    table.apply(frame(spark, ("a", "x", 1), ("b", "x", 2)), 0)
    before = rows(table.current())
    table.apply(frame(spark, ("z", "x", 99), ("c", "y", 1)), 1)
    table.apply(frame(spark, ("a", "x", 4), ("z", "x", 0), ("c", "y", 4)), 1)  # the batch again, with other rows
    assert [r for r in rows(table.current()) if r[0] != "z"] == expected
    assert rows(table.current(before=1)) == before
    if by_day:
        assert [r for r in rows(table.current(partitions=["x"])) if r[0] != "z"] == [r for r in expected if r[1] == "x"]


def test_a_batch_that_died_between_two_days_runs_again(spark, tmp_path):
    table = keyed(spark, tmp_path, "add", ("k", "g"), partition="g")
    table.apply(frame(spark, ("a", "x", 1), ("a", "y", 1)), 0)
    table.apply(frame(spark, ("a", "x", 10)), 1)  # of batch 1 only day x was written
    table.apply(frame(spark, ("a", "x", 10), ("a", "y", 10)), 1)
    assert rows(table.current()) == [("a", "x", 11), ("a", "y", 11)]


def test_insert_rule(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.AD_BLACKLIST, "insert", ("userid",))
    table.apply(spark.createDataFrame([(1,), (2,)], "userid bigint"), 0)
    table.apply(spark.createDataFrame([(2,), (3,)], "userid bigint"), 1)
    assert rows(table.current()) == [(1,), (2,), (3,)]


def test_a_day_has_two_versions_and_others_are_left_alone(spark, tmp_path):
    table = keyed(spark, tmp_path, "add", ("k", "g"), partition="g")
    for batch_id, day in enumerate(["x", "x", "y", "y", "x", "y", "y", "y"]):
        table.apply(frame(spark, ("a", day, 1)), batch_id)
        if batch_id == 1:
            files = {f: f.stat().st_mtime_ns for f in tmp_path.glob("part=x/version=1/batch=1/*.parquet")}
            assert files
        if batch_id == 3:
            assert {f: f.stat().st_mtime_ns for f in files} == files
        assert all(len(list(tmp_path.glob(f"part={d}/version=*/batch=*"))) <= 2 for d in "xy")
    assert rows(table.current()) == [("a", "x", 3), ("a", "y", 5)]


def test_batches_of_several_queries_are_told_apart(spark, tmp_path):
    table = keyed(spark, tmp_path, "add", ("k", "g"))
    for name in ("q0-0", "q1-0", "q1-0", "q1-1"):
        table.apply(frame(spark, ("a", "x", 1)), name)
    assert rows(table.current()) == [("a", "x", 3)]


@pytest.mark.parametrize(("most", "low", "high"), [(1_000_000, 1, 1), (100, 4, 11)])
def test_a_batch_writes_few_files_for_each_day(spark, tmp_path, monkeypatch, most, low, high):
    from pyspark.sql import functions as F
    from shoptrail.sinks import keyed as module

    monkeypatch.setattr(module, "FILE_ROWS", most)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a batch of a stateful query
    try:
        table = keyed(spark, tmp_path, "add", ("k", "g"), partition="g")
        day = F.when(F.col("id") < 990, "x").otherwise("y")
        table.apply(spark.range(1000).repartition(16).select(F.col("id").cast("string").alias("k"), day.alias("g"), F.col("id").alias("v")), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert low <= len(list(tmp_path.glob("part=x/*/*/*.parquet"))) <= high
    assert table.current().count() == 1000


def test_kafka_source_names_its_options(spark):
    """The connector is not part of a plain PySpark installation."""
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "host:9092", "ads")


def test_times_are_utc(spark):
    at = datetime(2024, 3, 1, 23, 59, 59)
    assert rows(ads.user_daily_counts(all_clicks(spark, [[ad_line(at=at)]])))[0][0] == "20240301"
