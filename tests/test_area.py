from conftest import dicts, rows
from shoptrail import fixed_values, schemas
from shoptrail.operators import area
from shoptrail.plans.area_job import area_products_in_sql, run_area_job
from shoptrail.sources.tables import city_areas
from shoptrail.params import TaskParams

from builders import action, action_table


def clicks(spark, *pairs):
    return spark.createDataFrame(list(pairs), "city_id bigint, click_product_id bigint")


def cities(spark):
    return spark.createDataFrame([(1, "A", "x"), (11, "A", "x"), (2, "B", "y")], schemas.CITY_AREA)


def products(spark, *extra):
    default = [(p, f"p{p}", '{"product_status": %d}' % (p % 2)) for p in range(1, 6)]
    return spark.createDataFrame(list(extra) or default, schemas.PRODUCT_INFO)


def test_cities_are_listed_once_and_in_order(spark):
    got = area.area_product_clicks(clicks(spark, (11, 5), (1, 5), (1, 5), (2, 5), (99, 5)), cities(spark))
    assert rows(got) == [("x", 5, 3, "11:A,1:A"), ("y", 5, 1, "2:B")]


def test_product_status(spark):
    table = products(
        spark,
        (1, "own", '{"product_status": 0}'),
        (2, "other", '{"product_status": 1}'),
        (3, "none", '{"x": 0}'),
        (4, "bad", "not json"),
        (5, "null", None),
    )
    per_area = area.area_product_clicks(clicks(spark, *((1, p) for p in range(1, 7))), cities(spark))
    got = {r.product_name: r.product_status for r in area.with_products(per_area, table).collect()}
    assert got == {
        "own": "Self",
        "other": "Thrid Party",
        "none": "Thrid Party",
        "bad": "Thrid Party",
        "null": "Thrid Party",
    }


def test_top_three_with_a_tie(spark):
    pairs = [(1, 4)] * 3 + [(1, 2)] * 2 + [(1, 5)] + [(1, 3)]
    per_area = area.area_product_clicks(clicks(spark, *pairs), cities(spark))
    top = area.area_top_products(area.with_products(per_area, products(spark)), "t")
    assert [(r["productid"], r["clickCount"]) for r in dicts(top)] == [(4, 3), (2, 2), (3, 1)]
    assert {r["areaLevel"] for r in dicts(top)} == {"D_Level"}


def test_sql_form_agrees(spark):
    pairs = clicks(spark, (11, 5), (1, 5), (1, 4), (2, 5), (99, 5), (2, 77))
    per_area = area.area_product_clicks(pairs, cities(spark))
    frames = area.with_products(per_area, products(spark))
    assert rows(area_products_in_sql(pairs, cities(spark), products(spark)).select(frames.columns)) == rows(frames)


def test_job_with_the_built_in_cities(spark):
    table = action_table(
        spark,
        [action(city_id=c, click_product_id=1, click_category_id=1) for c in range(10)] + [action(city_id=0)],
    )
    written = {}
    params = TaskParams("2024-03-01", "2024-03-01")
    run_area_job(table, products(spark), params, lambda df, name: written.update({name: dicts(df)}), task_id="t")
    (result,) = written.values()
    assert list(written) == ["area_top3_product_0912"]
    levels = {r["area"]: r["areaLevel"] for r in result}
    assert levels["华北"] == "A_Level" and levels["华中"] == "B_Level" and levels["西北"] == "C_Level"
    assert levels["东北"] == "D_Level" and len(levels) == 7
    assert sum(r["clickCount"] for r in result) == 10 == city_areas(spark).count() == len(fixed_values.CITY_AREAS)
