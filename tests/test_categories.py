from builders import action, action_table
from conftest import rows
from shoptrail.operators import categories
from shoptrail.operators.sessions import of_sessions
from shoptrail.params import TaskParams
from shoptrail.sources.tables import visit_actions

PARAMS = TaskParams("2024-01-01", "2024-12-31")


def scan(spark, actions):
    return visit_actions(action_table(spark, actions), PARAMS)


def counts(spark, actions):
    return categories.category_counts(categories.session_category_counts(scan(spark, actions)))


def test_counts_of_each_kind(spark):
    actions = [
        action(click_category_id=1),
        action(click_category_id=1, order_category_ids="2,2,3"),  # a row holding both
        action(pay_category_ids="4"),
        action(order_category_ids="3,", pay_category_ids="1"),
        action(search_keyword="x"),
    ]
    assert rows(counts(spark, actions)) == [(1, 2, 0, 1), (2, 0, 2, 0), (3, 0, 2, 0), (4, 0, 0, 1)]
    per_session = categories.session_category_counts(scan(spark, actions))
    assert rows(categories.category_clicks(per_session)) == [(1, 2)]
    assert rows(categories.category_orders(per_session)) == [(2, 2), (3, 2)]
    assert rows(categories.category_pays(per_session)) == [(1, 1), (4, 1)]


def test_order_of_the_top(spark):
    table = spark.createDataFrame(
        [(9, 5, 0, 0), (1, 5, 2, 0), (2, 5, 2, 3), (8, 5, 2, 3), (3, 3_000_000_000, 0, 0), (4, 1, 9, 9)],
        "categoryid bigint, clickCount bigint, orderCount bigint, payCount bigint",
    )
    top = categories.top_categories(table, "t", 5).collect()
    assert [r.categoryid for r in top] == [3, 2, 8, 1, 9]


def test_ten_of_twelve_equal_sessions(spark):
    actions = [action(session=f"s{i:02}", event=i, click_category_id=1) for i in range(12)]
    actions += [action(session="s11", event=50, click_category_id=1), action(session="s01", click_category_id=2)]
    kept = spark.createDataFrame([(f"s{i:02}",) for i in range(1, 12)], "session_id string")
    per_session = of_sessions(categories.session_category_counts(scan(spark, actions)), kept)
    top = categories.top_categories(categories.category_counts(per_session), "t", 1)
    got = [(r.sessionid, r.clickCount) for r in categories.top_category_sessions(per_session, top, "t").collect()]
    assert sorted(got) == [(f"s{i:02}", 1) for i in range(1, 10)] + [("s11", 2)]
