from conftest import dicts, rows

import pytest
from builders import action, action_table, user, user_table
from shoptrail.operators import buckets, sessions
from shoptrail.params import TaskParams
from shoptrail.sources.tables import visit_actions

from pyspark.sql import functions as F

DAYS = {"startDate": "2024-03-01", "endDate": "2024-03-31"}


def scan(spark, actions, params):
    return visit_actions(action_table(spark, actions), params)


def kept(spark, actions, users, **task):
    params = TaskParams.from_dict(DAYS | task)
    return sessions.kept_sessions(scan(spark, actions, params), user_table(spark, users), params)


def kept_ids(*args, **task):
    return [r.session_id for r in kept(*args, **task).orderBy("session_id").collect()]


def lengths(spark, seconds=(), steps=()):
    """One session per visit length, and one per step count."""
    visits = [(f"v{s}", s, 1) for s in seconds]
    counts = [(f"n{n}", 0, n) for n in steps]
    return spark.createDataFrame(visits + counts, "session_id string, visit_length bigint, step_length bigint")


def test_rollup_of_one_session(spark):
    actions = [
        action(seconds=9, event=3, search_keyword="cake"),
        action(seconds=0, event=1, search_keyword="cheesecake"),
        action(seconds=5, event=2, search_keyword="cheesecake"),
        action(seconds=5, event=4, search_keyword=""),
        *(action(seconds=6, event=10 + i, click_category_id=c) for i, c in enumerate([44, 1, 12, 1, 50])),
    ]
    row = kept(spark, actions, [user()]).first()
    assert row.search_keywords == "cake,cheesecake"
    assert row.click_category_ids == "1,12,44,50"
    assert (row.visit_length, row.step_length) == (9, 9)


@pytest.mark.parametrize(
    "first, second",
    [
        ({"event": 2**30 - 1}, {"event": 2**30}),
        ({"event": 2**31 + 5}, {"event": 2**40}),
        ({"event": 9, "action_time": "2024-03-01 12:00:00.100"}, {"event": 1, "action_time": "2024-03-01 12:00:00.900"}),
        ({"event": -(2**63)}, {"event": 2**63 - 1}),
        ({"event": None}, {"event": 0}),
    ],
)
def test_first_action_is_found_exactly(spark, first, second):
    for order in ([(first, 10), (second, 20)], [(second, 20), (first, 10)]):
        table = action_table(spark, [action(user_id=user, **values) for values, user in order])
        table = table.withColumn("action_time", F.to_timestamp("action_time"))
        assert sessions.session_rollup(table).first().user_id == 10


def test_first_action_without_event_id(spark):
    table = action_table(spark, [action(user_id=2**40), action(user_id=2**40 - 1)]).drop("event_id")
    assert sessions.session_rollup(table.withColumn("action_time", F.to_timestamp("action_time"))).first().user_id == 2**40 - 1


def test_session_belongs_to_the_user_of_its_first_action(spark):
    actions = [
        action(seconds=1, event=1, user_id=1),
        action(seconds=0, event=3, user_id=2),
        action(seconds=0, event=2, user_id=3),
    ]
    assert kept(spark, actions, [user(1), user(2), user(3)]).first().user_id == 3


def test_hours_without_leading_zero(spark):
    actions = [
        action(event=1, action_time="2024-03-01 5:03:07"),
        action(event=2, action_time="2024-03-01 15:03:07"),
    ]
    assert kept(spark, actions, [user()]).first().visit_length == 36000


def test_dates_are_closed_on_both_ends(spark):
    days = ["2024-02-29", "2024-03-01", "2024-03-31", "2024-04-01"]
    actions = [action(session=d, date=d) for d in days]
    assert kept_ids(spark, actions, [user()]) == days[1:3]


USERS = [user(1), user(2, age=19), user(3, professional="cook"), user(4, city="Rome"), user(5, sex="male")]
SESSIONS = [
    action(session="all", user_id=1, event=1, search_keyword="tea"),
    action(session="all", user_id=1, event=2, click_category_id=7),
    action(session="age", user_id=2, event=3, search_keyword="tea"),
    action(session="age", user_id=2, event=4, click_category_id=7),
    action(session="professional", user_id=3, event=5, search_keyword="tea", click_category_id=7),
    action(session="city", user_id=4, event=6, search_keyword="tea", click_category_id=7),
    action(session="sex", user_id=5, event=7, search_keyword="tea", click_category_id=7),
    action(session="keyword", user_id=1, event=8, search_keyword="coffee", click_category_id=7),
    action(session="category", user_id=1, event=9, search_keyword="tea", click_category_id=70),
    action(session="stranger", user_id=99, event=10, search_keyword="tea", click_category_id=7),
]
ALL_FILTERS = {
    "startAge": 20,
    "endAge": 30,
    "professionals": "coder,clerk",
    "cities": "Oslo",
    "sex": "female",
    "keywords": "tea,milk",
    "categoryIds": "7,8",
}


def test_all_filters_together(spark):
    assert kept_ids(spark, SESSIONS, USERS, **ALL_FILTERS) == ["all"]


@pytest.mark.parametrize(
    "failing, names",
    [
        ("age", ["startAge", "endAge"]),
        ("professional", ["professionals"]),
        ("city", ["cities"]),
        ("sex", ["sex"]),
        ("keyword", ["keywords"]),
        ("category", ["categoryIds"]),
    ],
)
def test_each_filter_alone(spark, failing, names):
    known = {a["session_id"] for a in SESSIONS} - {"stranger"}
    got = kept_ids(spark, SESSIONS, USERS, **{n: ALL_FILTERS[n] for n in names})
    assert got == sorted(known - {failing})


def test_empty_filters_let_every_known_session_pass(spark):
    empty = dict.fromkeys(ALL_FILTERS, "") | {"sex": None}
    assert len(kept_ids(spark, SESSIONS, USERS, **empty)) == 7


def test_one_age_bound_filters_only_when_strict():
    half = TaskParams.from_dict(DAYS | {"startAge": 20})
    assert half.start_age == 20 and half.end_age is None
    strict = TaskParams.from_dict(DAYS | {"startAge": 20}, strict_bounds=True)
    assert strict.strict_bounds


def test_one_age_bound(spark):
    assert "age" in kept_ids(spark, SESSIONS, USERS, startAge=20)
    params = TaskParams.from_dict(DAYS | {"startAge": 20}, strict_bounds=True)
    strict = sessions.kept_sessions(scan(spark, SESSIONS, params), user_table(spark, USERS), params)
    assert "age" not in [r.session_id for r in strict.collect()]


SECONDS = [0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEPS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 30, 31, 60, 61]


def counts(spark, limits, **which):
    row = buckets.bucket_counts(lengths(spark, **which), limits).first().asDict()
    return [v for k, v in row.items() if k.startswith("visit" if "seconds" in which else "step")]


def test_visit_buckets(spark):
    assert counts(spark, "reference", seconds=SECONDS) == [2, 2, 2, 2, 2, 2, 2, 2, 1]
    assert counts(spark, "closed", seconds=SECONDS) == [2, 3, 3, 3, 2, 2, 2, 2, 1]


def test_step_buckets(spark):
    assert counts(spark, "reference", steps=STEPS) == [2, 2, 2, 2, 2, 1]
    assert counts(spark, "closed", steps=STEPS) == [3, 3, 3, 3, 2, 1]


def test_ratio_rounds_half_up(spark):
    some = spark.range(200).selectExpr("CAST(id AS STRING) session_id", "IF(id < 57, 2L, 0L) visit_length", "1L step_length")
    row = buckets.length_ratios(some, "t").first()
    assert (row.session_count, row.visit_length_1s_3s_ratio) == (200, 0.29)


def test_no_sessions_give_zero_ratios(spark):
    row = buckets.length_ratios(lengths(spark, seconds=[1]).where("false"), "t").first()
    assert row.session_count == 0 and row.visit_length_1s_3s_ratio == 0.0


def test_long_form_agrees_with_wide_form(spark):
    some = lengths(spark, seconds=SECONDS, steps=STEPS)
    wide = buckets.length_ratios(some, "t").first().asDict()
    for row in dicts(buckets.length_buckets(some)):
        assert wide[row["bucket"] + "_ratio"] == row["ratio"]


def test_rows_of_sessions(spark):
    params = TaskParams.from_dict(DAYS)
    actions = scan(spark, SESSIONS, params)
    chosen = spark.createDataFrame([("all",), ("age",)], "session_id string")
    assert rows(sessions.of_sessions(actions, chosen).select("event_id")) == [(1,), (2,), (3,), (4,)]
