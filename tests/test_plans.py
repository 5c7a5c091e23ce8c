"""Properties of the physical plans that large inputs depend on."""

import re

import pytest

from checks.queries import all_queries

QUERIES = all_queries()


def plan(spark, folder, name):
    df = QUERIES[name](spark, folder)
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan parquet.*", text)


def test_ratios_read_three_columns_and_never_build_lists(spark, folder):
    text = plan(spark, folder, "session_length_ratios")
    (events,) = [s for s in scans(text) if "events.parquet" in s]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in events
    assert "GreaterThanOrEqual(ts," in events
    assert "collect_set" not in text and "SortAggregate" not in text


def test_filters_on_keywords_need_no_lists(spark, folder):
    text = plan(spark, folder, "kept_actions")
    assert "bool_or" in text or "max(" in text
    assert "collect_set" not in text


@pytest.mark.parametrize(
    "name", ["category_top10_sessions", "area_top3_products", "ad_province_top3", "session_sample_two_days"]
)
def test_groups_are_trimmed_before_the_shuffle(spark, folder, name):
    text = plan(spark, folder, name)
    assert re.search(r"WindowGroupLimit.* Partial", text) and re.search(r"WindowGroupLimit.* Final", text)


def test_top_categories_are_no_global_sort(spark, folder):
    text = plan(spark, folder, "category_top10")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_area_clicks_are_counted_before_the_join(spark, folder):
    lines = plan(spark, folder, "area_product_clicks").splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "city_id" in line)
    assert any("HashAggregate(keys=[city_id" in line for line in lines[join:])


def test_categories_are_counted_before_the_join(spark, folder):
    lines = plan(spark, folder, "category_full_counts").splitlines()
    join = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert any(re.search(r"HashAggregate\(keys=\[session_id.*categoryid", line) for line in lines[join:])


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("ad_stream", "ad_state", "sink"))))
def test_no_python_and_no_cross_join(spark, folder, name):
    if name == "session_job":
        pytest.skip("runs its parts, which are checked on their own")
    text = plan(spark, folder, name)
    assert not re.search(r"Python|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", text)
