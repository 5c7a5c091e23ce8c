"""The command line, on Parquet folders."""

import json
import os
import signal
import threading
from datetime import timedelta

import pytest
from builders import NOON, action, action_table, ad_line, user, user_table
from conftest import rows
from shoptrail import schemas
from shoptrail.jobs import main
from shoptrail.streaming.ad_job import AdTables


@pytest.fixture
def inputs(spark, tmp_path):
    data = [action(session=f"s{n}", seconds=i, event=10 * n + i, page_id=i) for n in range(3) for i in range(1, 4)]
    data += [action(session="s1", seconds=9, event=99, click_category_id=5, click_product_id=1)]
    action_table(spark, data).write.parquet(f"{tmp_path}/actions")
    user_table(spark, [user()]).write.parquet(f"{tmp_path}/users")
    products = spark.createDataFrame([(1, "p", '{"product_status": 0}')], schemas.PRODUCT_INFO)
    products.write.parquet(f"{tmp_path}/products")
    return tmp_path


def run(job, folder, **task):
    params = {"startDate": "2024-03-01", "endDate": "2024-03-01"} | task
    main(
        [job, "--params", json.dumps(params), "--actions", f"{folder}/actions", "--users", f"{folder}/users"]
        + ["--products", f"{folder}/products", "--task-id", "t", "--output", f"{folder}/out"]
    )


def test_session_job(spark, inputs):
    run("session", inputs, startAge=20, endAge=50)
    ratio = spark.read.parquet(f"{inputs}/out/session_stat_ratio_0911").first()
    assert (ratio.taskid, ratio.session_count) == ("t", 3)
    assert rows(spark.read.parquet(f"{inputs}/out/session_top10session_0912")) == [("t", 5, "s1", 1)]


def test_results_are_appended(spark, inputs):
    for _ in range(2):
        run("page", inputs, targetPageFlow="1,2,3")
    got = rows(spark.read.parquet(f"{inputs}/out/page_split_convert_rate_0912"))
    assert got == [("t", "1_2=0.75|2_3=1.0")] * 2


def test_area_job(spark, inputs):
    run("area", inputs)
    got = spark.read.parquet(f"{inputs}/out/area_top3_product_0912").first()
    assert (got.area, got.areaLevel, got.cityInfos, got.productStatus) == ("华北", "A_Level", "0:北京", "Self")


def test_ads_job(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("\n".join([ad_line()] * 101) + "\n")
    main(
        ["ads", "--lines", str(lines), "--tables", f"{tmp_path}/t", "--checkpoint", f"{tmp_path}/c", "--once"]
    )
    assert rows(AdTables.below(spark, f"{tmp_path}/t").blacklist.current()) == [(1,)]


def test_ads_state_job(spark, tmp_path):
    """Each statistic in a query of its own; started again with new lines, it goes on."""
    lines = tmp_path / "lines"
    lines.mkdir()
    for n, piece in enumerate(([ad_line()] * 3, [ad_line(at=NOON + timedelta(hours=3))])):
        (lines / f"{n}.txt").write_text("\n".join(piece) + "\n")
        for what in ("totals", "minutes", "hours", "bans"):
            main(
                ["ads-state", "--what", what, "--lines", str(lines), "--tables", f"{tmp_path}/t", "--checkpoint", f"{tmp_path}/{what}", "--once"]
                + ["--ban-above", "2", "--delay", "30 minutes"]
            )
    read = lambda what: spark.read.parquet(f"{tmp_path}/t/ad_{what}").drop("batch")
    table = AdTables.below(spark, f"{tmp_path}/t").city_totals
    assert rows(table.current()) == [("20240301", "North", "Oslo", 1, 4)]
    assert rows(read("minutes")) == [("20240301", "12", "00", 1, 3)]
    assert read("hours").count() == 60 and {r.clickCount for r in read("hours").collect()} == {3}
    assert rows(read("bans")) == [(1, 1, 3)]


def test_a_stream_ends_after_its_batch_on_sigterm(spark, tmp_path):
    from shoptrail import jobs

    query = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    before = signal.getsignal(signal.SIGTERM)
    timer = threading.Timer(3, os.kill, (os.getpid(), signal.SIGTERM))
    timer.start()
    jobs._until_stopped(query)
    assert not query.isActive and query.exception() is None and signal.getsignal(signal.SIGTERM) is before


def test_a_target_is_needed(inputs):
    with pytest.raises(SystemExit, match="--output"):
        main(["page", "--params", '{"startDate": "a", "endDate": "b"}', "--actions", f"{inputs}/actions"])
