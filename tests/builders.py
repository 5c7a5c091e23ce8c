"""Small input tables."""

from datetime import datetime, timedelta

from shoptrail import schemas

NOON = datetime(2024, 3, 1, 12)


def action(session="s1", seconds=0, event=0, **values):
    """A visit action ``seconds`` after noon."""
    at = NOON + timedelta(seconds=seconds)
    row = {
        "date": at.strftime("%Y-%m-%d"),
        "user_id": 1,
        "session_id": session,
        "page_id": 1,
        "action_time": at.strftime("%Y-%m-%d %H:%M:%S"),
        "search_keyword": None,
        "click_category_id": -1,
        "click_product_id": -1,
        "order_category_ids": None,
        "order_product_ids": None,
        "pay_category_ids": None,
        "pay_product_ids": None,
        "city_id": 0,
        "event_id": event,
    }
    return row | values


def action_table(spark, actions):
    names = [*schemas.USER_VISIT_ACTION.names, "event_id"]
    schema = "date string, user_id bigint, session_id string, page_id bigint, action_time string, " + ", ".join(
        f"{n} {'bigint' if n in ('click_category_id', 'click_product_id', 'city_id', 'event_id') else 'string'}"
        for n in names[5:]
    )
    return spark.createDataFrame([tuple(a[n] for n in names) for a in actions], schema)


def user(user_id=1, age=30, professional="coder", city="Oslo", sex="female"):
    return (user_id, f"user{user_id}", f"name{user_id}", age, professional, city, sex)


def user_table(spark, users):
    return spark.createDataFrame(users, schemas.USER_INFO)


def ad_line(at=NOON, province="North", city="Oslo", user=1, ad=1):
    # Times are UTC.
    millis = int((at - datetime(1970, 1, 1)).total_seconds() * 1000)
    return f"{millis} {province} {city} {user} {ad}"


def line_table(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")
