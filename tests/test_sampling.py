from datetime import datetime, timedelta

import pytest
from conftest import rows
from shoptrail.operators.ranking import top_per_group
from shoptrail.operators.sampling import hourly_counts, pick_sessions, sample_quota

from pyspark.sql import functions as F

DAY = datetime(2024, 3, 1)


def sessions(spark, counts, day=DAY):
    """``counts``: sessions per hour."""
    data = [
        (f"{day:%d}-{hour}-{i}", day + timedelta(hours=hour, seconds=i)) for hour, n in counts.items() for i in range(n)
    ]
    return spark.createDataFrame(data, "session_id string, start_time timestamp").withColumn(
        "start_time", F.col("start_time").cast("timestamp_ntz")
    )


def quotas(df, allowance=100):
    return {(r.date, r.hour): r.quota for r in sample_quota(hourly_counts(df), allowance).collect()}


def test_quota_of_one_day(spark):
    got = quotas(sessions(spark, {0: 1, 5: 10, 23: 89}))
    assert got == {("2024-03-01", "00"): 1, ("2024-03-01", "05"): 10, ("2024-03-01", "23"): 89}


def test_quota_of_two_days(spark):
    both = sessions(spark, {0: 1, 5: 10, 23: 89}).union(sessions(spark, {1: 30, 2: 10}, DAY + timedelta(days=1)))
    got = quotas(both)
    assert got["2024-03-01", "23"] == 44 and got["2024-03-01", "00"] == 0
    assert got["2024-03-02", "01"] == 30  # never more than there are
    assert got["2024-03-02", "02"] == 10


def test_more_days_than_allowance_give_none(spark):
    days = [sessions(spark, {1: 2}, DAY + timedelta(days=i)) for i in range(3)]
    df = days[0].union(days[1]).union(days[2])
    assert set(quotas(df, allowance=2).values()) == {0}


def test_sample_has_exactly_the_quotas_and_is_repeatable(spark):
    df = sessions(spark, {0: 40, 5: 100, 23: 60})
    picked = pick_sessions(df, 50, "a")
    per_hour = {(r.date, r.hour): r.session_count for r in hourly_counts(picked).collect()}
    assert per_hour == {k: v for k, v in quotas(df, 50).items() if v}
    assert rows(picked) == rows(pick_sessions(df.repartition(7), 50, "a"))
    assert rows(picked) != rows(pick_sessions(df, 50, "b"))


@pytest.mark.parametrize("k", [3, 1500])
def test_top_per_group_equals_a_plain_window(spark, k):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("v"))
    got = rows(top_per_group(df, ["g"], [F.asc("v")], k))
    by_group = {}
    for g, v in sorted(tuple(r) for r in df.collect()):
        by_group.setdefault(g, []).append(v)
    want = [(g, v, i + 1) for g, vs in by_group.items() for i, v in enumerate(sorted(vs)[:k])]
    assert got == sorted(want, key=repr)
