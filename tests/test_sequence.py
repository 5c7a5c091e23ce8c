"""Next and previous row, with and without groups that are cut into pieces."""

import pytest
from builders import action, action_table
from conftest import rows
from shoptrail.operators import funnel, gaps
from shoptrail.operators.sequence import add_neighbour, frequent_keys
from shoptrail.params import TaskParams
from shoptrail.sources.tables import visit_actions

from pyspark.sql import Window
from pyspark.sql import functions as F

PARAMS = TaskParams("2024-01-01", "2024-12-31")


def skewed(spark, n=30_000):
    """One key with a third of all rows (half of them at the same time), one null key, many small."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))
        ).alias("key"),
        F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(97))).cast("bigint").alias("time"),
        F.xxhash64("id", F.lit(1)).alias("tie"),
        F.col("id").alias("value"),
    )


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("partitions", ["3", "40"])
def test_cut_groups_give_the_same_rows(spark, step, partitions):
    df = skewed(spark)
    window = Window.partitionBy("key").orderBy("time", "tie")
    plain = df.withColumn("other", (F.lead if step > 0 else F.lag)("value").over(window))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        cut = add_neighbour(df, "key", ["time", "tie"], {"value": "other"}, step, hot_rows=500)
        assert rows(cut.select(plain.columns)) == rows(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_frequent_keys(spark):
    assert {r.key for r in frequent_keys(skewed(spark), "key", 500).collect()} == {"hot", None}
    assert frequent_keys(skewed(spark), "key", 50_000).count() == 0


def test_branch_for_frequent_keys_costs_nothing_without_any(spark):
    df = skewed(spark)
    result = add_neighbour(df, "key", ["time", "tie"], {"value": "other"}, 1)
    result.write.format("noop").mode("overwrite").save()
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "rangepartitioning" not in plan and "SPARK_PARTITION_ID" not in plan


def visits(spark, **pages):
    """Sessions given as lists of pages, one second apart."""
    data = [
        action(session=s, seconds=i, event=100 * n + i, page_id=p)
        for n, (s, ps) in enumerate(pages.items())
        for i, p in enumerate(ps)
    ]
    return visit_actions(action_table(spark, data), PARAMS)


def test_page_flow(spark):
    actions = visits(spark, a=[1, 2, 3], b=[1, 2, 1, 2], c=[2, 1], d=[3])
    moves = funnel.page_moves(actions)
    assert rows(funnel.page_pairs(moves)) == [(1, 2, 3), (2, 1, 2), (2, 3, 1)]
    got = rows(funnel.flow_rates(moves, "1,2,3,4,5"))
    assert got == [
        (1, "1_2", 3, 4, 0.75),
        (2, "2_3", 1, 3, 1 / 3),
        (3, "3_4", 0, 1, 0.0),
        (4, "4_5", 0, 0, None),
    ]
    text = funnel.flow_rate_text(moves, "1,2,3,4,5", "t").first()
    assert (text.taskid, text.convertRate) == ("t", f"1_2=0.75|2_3={1 / 3}|3_4=0.0|4_5=null")


def test_flow_with_a_repeated_step(spark):
    moves = funnel.page_moves(visits(spark, a=[1, 2, 1, 2]))
    got = [(r.pair, r.moves, r.base) for r in funnel.flow_rates(moves, "1,2,1,2").orderBy("step").collect()]
    assert got == [("1_2", 2, 2), ("2_1", 1, 2), ("1_2", 2, 1)]


@pytest.mark.parametrize("flow", ["1", ""])
def test_flow_without_a_step(spark, flow):
    moves = funnel.page_moves(visits(spark, a=[1, 2]))
    assert funnel.flow_rates(moves, flow).collect() == []
    assert [tuple(r) for r in funnel.flow_rate_text(moves, flow, "t").collect()] == [("t", "")]


def test_hot_keys_are_counted_without_a_single_task(spark):
    plan = frequent_keys(skewed(spark), "key", 500)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "approx_top_k" not in plan


def test_flow_without_any_action(spark):
    moves = funnel.page_moves(visits(spark, a=[9]))
    assert [r.moves for r in funnel.flow_rates(moves, "1,2,3").collect()] == [0, 0]


def test_same_second_is_ordered_by_event(spark):
    data = [action(event=2, page_id=2), action(event=1, page_id=1), action(event=3, page_id=3)]
    moves = funnel.page_moves(visit_actions(action_table(spark, data), PARAMS))
    assert rows(funnel.page_pairs(moves)) == [(1, 2, 1), (2, 3, 1)]


def test_without_event_id(spark):
    actions = visits(spark, a=[1, 2, 3]).drop("event_id")
    assert rows(funnel.page_pairs(funnel.page_moves(actions))) == [(1, 2, 1), (2, 3, 1)]


def test_gaps(spark):
    data = [action(event=1), action(event=2, seconds=90), action(event=3, seconds=90)]
    got = gaps.action_gaps(visit_actions(action_table(spark, data), PARAMS)).orderBy("event_id").collect()
    assert [r.gap_seconds for r in got] == [None, 90, 0]
    assert [r.previous_is_before for r in got] == [None, True, False]
    assert (got[1].day_key, got[1].day, got[1].minute_key, got[1].hour) == (
        "20240301",
        "2024-03-01",
        "202403011201",
        "12",
    )
