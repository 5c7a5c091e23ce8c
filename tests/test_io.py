import os

import pytest
from builders import action, action_table, user, user_table
from conftest import rows
from shoptrail.fixed_values import RESULT_TABLES
from shoptrail.functions import text, times
from shoptrail.functions.sql import register_functions
from shoptrail.params import TaskParams
from shoptrail.plans.page_job import run_page_job
from shoptrail.plans.session_job import run_session_job
from shoptrail.sinks.jdbc import jdbc_options
from shoptrail.sinks.tables import register_views, replace_table
from shoptrail.sources.tables import in_dates, user_info
from shoptrail.storage import Staging, new_folder

from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_text_functions(spark):
    assert value(spark, text.trim_commas(F.lit(",a,b,"))) == "a,b"
    assert [value(spark, text.two_digits(F.lit(s))) for s in ("5", "12", "123")] == ["05", "12", "123"]
    assert value(spark, text.is_empty(F.lit(""))) and not value(spark, text.is_not_empty(F.lit(None)))


def test_time_functions(spark):
    at = times.parse_time(F.lit("2019-09-10 5:03:07"))
    assert value(spark, times.format_time(at)) == "2019-09-10 05:03:07"
    assert value(spark, times.format_date(at)) == "2019-09-10"
    assert value(spark, times.date_hour(at)) == "2019-09-10_05"
    assert value(spark, times.minute_key(at)) == "201909100503"
    assert value(spark, times.parse_time(F.lit("no time"))) is None
    assert value(spark, times.parse_day_key(F.lit("20190910"))).isoformat() == "2019-09-10"
    assert value(spark, times.today() > times.yesterday())


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        "SELECT concat_long_string(7, 'x', ':') AS a, get_json_field('{\"k\": 1}', 'k') AS b, get_json_field('?', 'k') AS c"
    ).first()
    assert tuple(row) == ("7:x", "1", None)


def test_params():
    p = TaskParams.from_dict(
        {"startDate": "a", "endDate": "b", "startAge": 20, "endAge": "50", "cities": "", "categoryIds": "1,2"}
    )
    assert (p.start_age, p.end_age, p.cities, p.category_ids, p.keywords) == (20, 50, (), (1, 2), ())
    assert (TaskParams.from_dict({"startDate": "a"}).end_date, TaskParams.from_dict({"endDate": ""}).start_date) == (None, None)


def test_a_task_without_dates_is_about_yesterday_and_today(spark):
    """By the session's clock and time zone, as text and as date columns; one date given leaves the other's default."""
    days = spark.range(5).select(F.date_sub(F.current_date(), F.col("id").cast("int")).alias("date"), F.col("id"))
    for table in (days, days.withColumn("date", F.col("date").cast("string"))):
        assert rows(in_dates(table, TaskParams.from_dict({})).select("id")) == [(0,), (1,)]
        assert rows(in_dates(table, TaskParams.from_dict({"startDate": "2000-01-01"})).select("id")) == [(n,) for n in range(5)]
        assert rows(in_dates(table, TaskParams.from_dict({"endDate": days.where("id = 1").first()["date"].isoformat()})).select("id")) == [(1,)]


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t", "u", connections=4) == {
        "url": "jdbc:x",
        "dbtable": "t",
        "user": "u",
        "numPartitions": "4",
    }


def test_replace_table(spark, tmp_path):
    users = user_table(spark, [user(1), user(2)])
    replace_table(users, "user_info", partition_by="sex")
    replace_table(users.limit(1), "user_info")
    assert user_info(spark).count() == 1
    register_views(some_users=users)
    assert spark.sql("SELECT count(*) FROM some_users").first()[0] == 2
    spark.sql("DROP TABLE user_info")


def test_staged_tables_are_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    with Staging(spark, "test") as staging:
        df = staging.table(spark.range(5), "five")
        assert df.count() == 5 and all(shared in f for f in df.inputFiles())
        assert os.path.exists(staging.folder)
    assert not os.path.exists(staging.folder)
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_session_job_writes_its_four_tables(spark):
    data = [action(session=f"s{i}", event=2 * i, click_category_id=i % 3, search_keyword="k") for i in range(20)]
    data += [action(session=f"s{i}", seconds=2, event=2 * i + 1, order_category_ids="1,2") for i in range(20)]
    written = {}
    params = TaskParams("2024-03-01", "2024-03-01", start_age=20, end_age=40)
    task = run_session_job(
        action_table(spark, data), user_table(spark, [user()]), params, lambda df, t: written.update({t: df.collect()})
    )
    assert set(written) == {
        RESULT_TABLES[k] for k in ("session_ratio", "session_sample", "top_categories", "top_category_sessions")
    }
    assert all(r.taskid == task for table in written.values() for r in table)
    (ratio,) = written[RESULT_TABLES["session_ratio"]]
    assert (ratio.session_count, ratio.visit_length_1s_3s_ratio, ratio.step_length_1_3_ratio) == (20, 1.0, 1.0)
    assert len(written[RESULT_TABLES["session_sample"]]) == 20
    assert [r.categoryid for r in written[RESULT_TABLES["top_categories"]]] == [1, 0, 2]
    assert len(written[RESULT_TABLES["top_category_sessions"]]) == 20


def test_page_job(spark):
    data = [action(seconds=i, event=i, page_id=i) for i in range(1, 4)]
    written = {}
    params = TaskParams("2024-03-01", "2024-03-01", page_flow="1,2,3")
    run_page_job(action_table(spark, data), params, lambda df, t: written.update({t: rows(df)}), "t")
    assert written == {"page_split_convert_rate_0912": [("t", "1_2=1.0|2_3=1.0")]}
