from datetime import datetime, timedelta

from builders import NOON, ad_line, line_table
from conftest import rows
from shoptrail.operators import ads
from shoptrail.sources.ad_log import parse_ad_lines


def clicks(spark, lines):
    return parse_ad_lines(line_table(spark, lines))


def test_malformed_lines_are_dropped(spark):
    lines = [ad_line(), "", "x y z", "12 a b c 4", ad_line() + " tail", "1 a b 2"]
    assert clicks(spark, lines).count() == 2


def test_malformed_lines_are_counted(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    parse_ad_lines(line_table(spark, [ad_line(), "bad"]), observe_as=seen).count()
    assert seen.get == {"lines": 2, "malformed": 1}


def test_ban_needs_more_than_the_limit_on_one_ad_and_day(spark):
    midnight = datetime(2024, 3, 2)
    lines = [ad_line(user=1)] * 100 + [ad_line(user=2)] * 101
    lines += [ad_line(user=3, ad=a) for a in (1, 2) for _ in range(60)]
    lines += [ad_line(user=4, at=midnight + timedelta(seconds=s)) for s in range(-60, 60)]
    counts = ads.user_daily_counts(clicks(spark, lines))
    assert rows(ads.users_to_ban(counts)) == [(2,)]
    assert counts.where("userid = 4").count() == 2


def test_underscores_in_names_are_kept(spark):
    got = ads.city_totals(clicks(spark, [ad_line(province="North_East", city="New_York")]))
    assert rows(got) == [("20240301", "North_East", "New_York", 1, 1)]


def test_top_ads_of_a_province(spark):
    lines = [ad_line(city=c, ad=a) for c in ("Oslo", "Bergen") for a in range(5, 0, -1)] + [ad_line(ad=5)]
    got = ads.province_top_ads(ads.city_totals(clicks(spark, lines)))
    assert rows(got) == [("20240301", "North", 1, 2), ("20240301", "North", 2, 2), ("20240301", "North", 5, 3)]


def test_trend_and_last_hour(spark):
    at = [0, 30, 60, 3599, 3600, 3660]
    got = clicks(spark, [ad_line(at=NOON + timedelta(seconds=s)) for s in at])
    assert rows(ads.minute_trend(got)) == [
        ("20240301", "12", "00", 1, 2),
        ("20240301", "12", "01", 1, 1),
        ("20240301", "12", "59", 1, 1),
        ("20240301", "13", "00", 1, 1),
        ("20240301", "13", "01", 1, 1),
    ]
    assert [r[4] for r in rows(ads.last_hour(got))] == [2, 3, 4, 3, 3]


def test_city_totals_add_up_to_province_totals(spark, folder):
    from checks.queries import all_queries

    cities = all_queries()["ad_city_totals"](spark, folder)
    provinces = all_queries()["ad_province_totals"](spark, folder)
    total = "SUM(clickCount)"
    assert cities.selectExpr(total).first() == provinces.selectExpr(total).first()
