"""Command line of the jobs.

    spark-submit shoptrail/jobs.py session --params '{"startDate": ..., "endDate": ...}' --output s3a://...
    spark-submit shoptrail/jobs.py ads --brokers host:9092 --topics ads --tables ... --checkpoint ...
    spark-submit shoptrail/jobs.py ads-state --what totals --brokers host:9092 --topics ads --tables ... --checkpoint ...

Inputs are catalog tables by default, or Parquet folders when the name holds a slash. Results go
to a JDBC database (``--jdbc-url``, password in ``JDBC_PASSWORD``) or to Parquet tables below
``--output``. A stream that gets SIGTERM ends after the batch it is in.
"""

from __future__ import annotations

import argparse
import json
import os
import signal
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql.streaming import StreamingQuery  # noqa: E402

from shoptrail import schemas  # noqa: E402
from shoptrail.fixed_values import BAN_ABOVE_CLICKS, RESULT_TABLES, SAMPLE_ALLOWANCE  # noqa: E402
from shoptrail.params import TaskParams  # noqa: E402
from shoptrail.plans.area_job import run_area_job  # noqa: E402
from shoptrail.plans.page_job import run_page_job  # noqa: E402
from shoptrail.plans.session_job import run_session_job  # noqa: E402
from shoptrail.sinks.jdbc import append_jdbc  # noqa: E402
from shoptrail.sinks.keyed import KeyedTable  # noqa: E402
from shoptrail.sources.ad_log import file_lines, kafka_lines, parse_ad_lines  # noqa: E402
from shoptrail.storage import claim  # noqa: E402
from shoptrail.streaming import stateful  # noqa: E402
from shoptrail.streaming.ad_job import AdTables, start_ad_job  # noqa: E402
from shoptrail.streaming.lifecycle import stop_between_batches  # noqa: E402


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shoptrail")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("session", "page", "area"):
        job = jobs.add_parser(name)
        job.add_argument("--params", required=True, help="task parameters as a JSON object")
        job.add_argument("--actions", default="user_visit_action")
        job.add_argument("--users", default="user_info")
        job.add_argument("--products", default="product_info")
        job.add_argument("--cities", help="city dimension; the built-in one if not given")
        job.add_argument("--allowance", type=int, default=SAMPLE_ALLOWANCE, help="sessions to sample")
        job.add_argument("--buckets", choices=("reference", "closed"), default="reference")
        job.add_argument("--task-id")
        job.add_argument("--jdbc-url")
        job.add_argument("--jdbc-user")
        job.add_argument("--output", help="folder for Parquet results")
    for name in ("ads", "ads-state"):
        ads = jobs.add_parser(name)
        ads.add_argument("--brokers")
        ads.add_argument("--topics")
        ads.add_argument("--lines", help="folder of text files instead of Kafka")
        ads.add_argument("--tables", required=True, help="folder of the result tables")
        ads.add_argument("--checkpoint", required=True)
        ads.add_argument("--ban-above", type=int, default=BAN_ABOVE_CLICKS)
        ads.add_argument("--once", action="store_true", help="process what is there and stop")
    ads.add_argument("--what", choices=("totals", "minutes", "hours", "bans"), required=True, help="the statistic that this query keeps in state")
    ads.add_argument("--delay", default=stateful.DELAY, help="how much later than the newest click a click may come")
    return parser.parse_args(argv)


def _table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def _writer(args: argparse.Namespace):
    if args.jdbc_url:
        password = os.environ.get("JDBC_PASSWORD")
        return lambda df, table: append_jdbc(
            df, args.jdbc_url, table, user=args.jdbc_user, password=password
        )
    if not args.output:
        raise SystemExit("give --jdbc-url or --output")
    return lambda df, table: df.write.mode("append").parquet(f"{args.output}/{table}")


def run_batch_job(spark: SparkSession, args: argparse.Namespace) -> None:
    params = TaskParams.from_dict(json.loads(args.params))
    actions, write = _table(spark, args.actions), _writer(args)
    if args.job == "session":
        run_session_job(
            actions, _table(spark, args.users), params, write, args.task_id, args.allowance, args.buckets
        )
    elif args.job == "page":
        run_page_job(actions, params, write, args.task_id)
    else:
        cities = _table(spark, args.cities) if args.cities else None
        run_area_job(actions, _table(spark, args.products), params, write, cities, args.task_id)


def _lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return file_lines(spark, args.lines) if args.lines else kafka_lines(spark, args.brokers, args.topics)


def _until_stopped(query: StreamingQuery) -> None:
    """Wait for the query's end; SIGTERM stops it between two batches."""
    asked = []
    before = signal.signal(signal.SIGTERM, lambda *_: asked.append(True))
    try:
        while not query.awaitTermination(1):
            if asked:
                stop_between_batches(query)
    finally:
        signal.signal(signal.SIGTERM, before)


def run_ads(spark: SparkSession, args: argparse.Namespace) -> None:
    trigger = {"availableNow": True} if args.once else None
    if args.job == "ads":
        _until_stopped(start_ad_job(_lines(spark, args), AdTables.below(spark, args.tables), args.checkpoint, args.ban_above, trigger))
        return
    clicks = parse_ad_lines(_lines(spark, args), observe_as="ad_lines")
    if args.what == "totals":
        folder = f"{args.tables}/{RESULT_TABLES['ad_city_totals']}"
        table = KeyedTable(spark, folder, schemas.AD_CITY_TOTALS, "replace", ("date", "province", "city", "adid"), "clickCount", "date")
        name = claim(spark, args.tables, args.checkpoint)
        query = stateful.start(stateful.running_totals(clicks, args.delay), "update", args.checkpoint, lambda rows, n: table.apply(rows, f"{name}-{n}"), trigger)
    else:
        results = {
            "minutes": lambda: (stateful.minute_counts(clicks, args.delay), "append"),
            "hours": lambda: (stateful.sliding_hours(clicks, args.delay), "append"),
            "bans": lambda: (stateful.ban_users(clicks, args.ban_above, args.delay), "update"),
        }
        result, mode = results[args.what]()
        # a batch that runs again writes to the same place
        query = stateful.start(result, mode, args.checkpoint, lambda rows, n: rows.write.mode("overwrite").parquet(f"{args.tables}/ad_{args.what}/batch={n}"), trigger)
    _until_stopped(query)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    builder = SparkSession.builder.appName(f"shoptrail-{args.job}")
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    (run_ads if args.job.startswith("ads") else run_batch_job)(spark, args)


if __name__ == "__main__":
    main()
