"""Every operator as a query on the star-schema tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas
from shoptrail.fixed_values import RESULT_TABLES
from shoptrail.functions.text import trim_commas
from shoptrail.operators import ads, area, buckets, categories, funnel, gaps, sampling, sessions
from shoptrail.params import TaskParams
from shoptrail.plans.area_job import area_products_in_sql
from shoptrail.plans.session_job import run_session_job
from shoptrail.sinks.keyed import KeyedTable
from shoptrail.operators.sequence import HOT_ROWS, frequent_keys
from shoptrail.sinks.row_files import RowFilesSource
from shoptrail.sinks.tables import replace_bucketed, replace_table
from shoptrail.sources import retail_tables as retail
from shoptrail.sources.ad_log import parse_ad_lines
from shoptrail.sources.tables import city_areas, product_clicks, visit_actions
from shoptrail.storage import delete_at_end, new_folder
from shoptrail.streaming import running, stateful
from shoptrail.streaming.ad_job import AdTables, start_ad_job
from shoptrail.streaming.lifecycle import stop_between_batches

TASK = "task-1"
SEED = "7"
# Every day that a table can hold: where dates are not the feature, no event is left out.
ALL_DAYS = {"startDate": "0001-01-01", "endDate": "9999-12-31", "targetPageFlow": "1,2,3,4,5,6,7"}
SOME_DAYS = ALL_DAYS | {"startDate": "2024-01-05", "endDate": "2024-01-20"}
TWO_DAYS = ALL_DAYS | {"startDate": "2024-01-05", "endDate": "2024-01-06"}
FILTERS = {
    "age": {"startAge": 20, "endAge": 50},
    "professional": {"professionals": "BUILDING,MACHINERY,HOUSEHOLD"},
    "city": {"cities": "city1,city2,city3,city5,city8,city13,city21"},
    "sex": {"sex": "male"},
    "keyword": {"keywords": "kw1,kw2,kw3,kw5,kw8"},
    "category": {"categoryIds": ",".join(str(c) for c in range(10, 70))},
}
# With many days the default allowance of 100 sessions truncates to none per hour.
BIG_ALLOWANCE = 3000
# The given events hold at most three clicks of one user on one ad in a day.
BAN_ABOVE = 1
LEVELS = {"AFRICA": "A_Level", "AMERICA": "A_Level", "ASIA": "B_Level", "EUROPE": "C_Level"}

Query = Callable[[SparkSession, str], DataFrame]
_found: dict[str, Query] = {}


def _scratch(spark: SparkSession, label: str) -> str:
    """A folder of this run, deleted when the application ends."""
    folder = new_folder(spark, label)
    delete_at_end(spark, folder)
    return folder


def query(name: str):
    """Register a query; times are read and shown in UTC."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        _found[name] = run
        return run

    return register


# --- inputs ---------------------------------------------------------------------------------


def _params(task: dict = ALL_DAYS, **filters) -> TaskParams:
    return TaskParams.from_dict(task | filters)


def _action_table(spark, folder, params) -> DataFrame:
    return retail.user_visit_action(retail.read(spark, folder, "events"), params)


def _actions(spark, folder, task: dict = ALL_DAYS) -> DataFrame:
    params = _params(task)
    return visit_actions(_action_table(spark, folder, params), params)


def _users(spark, folder) -> DataFrame:
    return retail.user_info(retail.read(spark, folder, "customer"))


def _products(spark, folder) -> DataFrame:
    return retail.product_info(retail.read(spark, folder, "part"))


def _cities(spark, folder) -> DataFrame:
    return retail.city_area(retail.read(spark, folder, "nation"), retail.read(spark, folder, "region"))


def _actions_and_kept(spark, folder, task: dict = ALL_DAYS) -> tuple[DataFrame, DataFrame]:
    actions = _actions(spark, folder, task)
    return actions, sessions.kept_sessions(actions, _users(spark, folder), _params(task))


def _kept(spark, folder, task: dict = ALL_DAYS) -> DataFrame:
    return _actions_and_kept(spark, folder, task)[1]


def _per_session(spark, folder) -> DataFrame:
    actions, kept = _actions_and_kept(spark, folder)
    return sessions.of_sessions(categories.session_category_counts(actions), kept)


def _clicks(spark, folder) -> DataFrame:
    params = _params()
    return product_clicks(_action_table(spark, folder, params), params)


def _ad_clicks(spark, folder) -> DataFrame:
    events = retail.read(spark, folder, "events")
    return parse_ad_lines(retail.ad_lines(events, _cities(spark, folder)))


def _ad_line_stream(spark, folder) -> DataFrame:
    """The events as a stream of ad log lines."""
    schema = retail.read(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")
    return retail.ad_lines(events, _cities(spark, folder))


# --- sources --------------------------------------------------------------------------------


@query("visit_actions_in_dates")
def _(spark, folder):
    actions = _actions(spark, folder, SOME_DAYS)
    return actions.withColumns(
        {
            "date": F.date_format("date", "yyyy-MM-dd"),
            "action_time": F.date_format("action_time", "yyyy-MM-dd HH:mm:ss"),
        }
    )


@query("product_clicks")
def _(spark, folder):
    return _clicks(spark, folder).groupBy("city_id", "click_product_id").agg(F.count("*").alias("clicks"))


# --- sessions -------------------------------------------------------------------------------


def _show_sessions(df: DataFrame) -> DataFrame:
    time = "yyyy-MM-dd HH:mm:ss"
    return df.select(
        "session_id",
        "user_id",
        F.date_format("start_time", time).alias("start_time"),
        F.date_format("end_time", time).alias("end_time"),
        "visit_length",
        "step_length",
        "search_keywords",
        "click_category_ids",
        "age",
        "professional",
        "city",
        "sex",
    )


@query("session_rollup")
def _(spark, folder):
    return _show_sessions(_kept(spark, folder))


def _register_filter(name: str, task: dict) -> None:
    @query(name)
    def _(spark, folder):
        return _show_sessions(_kept(spark, folder, task))


for _name, _filter in FILTERS.items():
    _register_filter(f"session_filter_{_name}", ALL_DAYS | _filter)
_register_filter(
    "session_filtered", ALL_DAYS | {k: v for task in FILTERS.values() for k, v in task.items()}
)


@query("session_length_ratios")
def _(spark, folder):
    return buckets.length_ratios(_kept(spark, folder), TASK)


@query("session_length_ratios_closed")
def _(spark, folder):
    return buckets.length_ratios(_kept(spark, folder), TASK, "closed")


@query("session_length_buckets_long")
def _(spark, folder):
    return buckets.length_buckets(_kept(spark, folder))


@query("session_counters")
def _(spark, folder):
    """The same from counters that the write of the sessions has filled."""
    rows, counters = buckets.observed(_kept(spark, folder).select("session_id", "visit_length", "step_length"))
    rows.write.parquet(f"{_scratch(spark, 'session-counters')}/rows")
    return buckets.buckets_of(buckets.counted(spark, counters))


def _bucketed_actions(spark, folder, name: str) -> DataFrame:
    """The actions as a table bucketed by session."""
    table = f"shoptrail_actions_{name}"
    replace_bucketed(_actions(spark, folder), table, "session_id", "action_time", 8, f"{_scratch(spark, table)}/rows")
    return spark.read.table(table)


@query("session_rollup_bucketed")
def _(spark, folder):
    actions = _bucketed_actions(spark, folder, "rollup")
    return _show_sessions(sessions.kept_sessions(actions, _users(spark, folder), _params()))


@query("kept_actions_bucketed")
def _(spark, folder):
    task = ALL_DAYS | FILTERS["age"] | FILTERS["sex"] | FILTERS["keyword"]
    actions = _bucketed_actions(spark, folder, "kept")
    kept = sessions.kept_sessions(actions, _users(spark, folder), _params(task))
    return sessions.of_sessions(actions, kept).select(
        "session_id", "event_id", "page_id", "click_product_id", "order_product_ids", "pay_product_ids"
    )


@query("page_pairs_bucketed")
def _(spark, folder):
    actions = _bucketed_actions(spark, folder, "pairs")
    hot = None if frequent_keys(actions, "session_id").isEmpty() else HOT_ROWS
    return funnel.page_pairs(funnel.page_moves(actions, hot))


@query("actions_of_default_dates")
def _(spark, folder):
    """Actions of a task without dates: yesterday and today. The events are moved so that their last day is today."""
    events = retail.read(spark, folder, "events")
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    moved = F.timestamp_add("DAY", F.date_diff(F.current_date(), F.lit(last)), F.col("ts")).cast("timestamp_ntz")
    recent = events.withColumn("ts", moved)
    params = TaskParams.from_dict({})
    actions = visit_actions(retail.user_visit_action(recent, params), params)
    return actions.groupBy(F.date_diff(F.current_date(), "date").alias("days_ago")).agg(F.count("*").alias("actions"))


@query("session_hourly_counts")
def _(spark, folder):
    return sampling.hourly_counts(_kept(spark, folder))


@query("session_sample_quota")
def _(spark, folder):
    return sampling.sample_quota(sampling.hourly_counts(_kept(spark, folder)), BIG_ALLOWANCE)


@query("session_sample")
def _(spark, folder):
    return sampling.session_sample(*_actions_and_kept(spark, folder), TASK, BIG_ALLOWANCE, SEED)


@query("session_sample_two_days")
def _(spark, folder):
    return sampling.session_sample(*_actions_and_kept(spark, folder, TWO_DAYS), TASK, seed=SEED)


@query("session_sample_detail")
def _(spark, folder):
    return sampling.sample_detail(*_actions_and_kept(spark, folder), TASK, BIG_ALLOWANCE, SEED)


# --- categories -----------------------------------------------------------------------------


@query("kept_actions")
def _(spark, folder):
    """Actions per kept session, with filters."""
    task = ALL_DAYS | FILTERS["age"] | FILTERS["sex"] | FILTERS["keyword"]
    actions, kept = _actions_and_kept(spark, folder, task)
    return sessions.of_sessions(actions, kept).select(
        "session_id", "event_id", "page_id", "click_product_id", "order_product_ids", "pay_product_ids"
    )


@query("session_category_counts")
def _(spark, folder):
    return _per_session(spark, folder)


@query("category_clicks")
def _(spark, folder):
    return categories.category_clicks(_per_session(spark, folder))


@query("category_orders")
def _(spark, folder):
    return categories.category_orders(_per_session(spark, folder))


@query("category_pays")
def _(spark, folder):
    return categories.category_pays(_per_session(spark, folder))


@query("category_full_counts")
def _(spark, folder):
    return categories.category_counts(_per_session(spark, folder))


@query("category_top10")
def _(spark, folder):
    return categories.top_categories(categories.category_counts(_per_session(spark, folder)), TASK)


@query("category_top10_sessions")
def _(spark, folder):
    per_session = _per_session(spark, folder)
    top = categories.top_categories(categories.category_counts(per_session), TASK)
    return categories.top_category_sessions(per_session, top, TASK)


def _session_job(spark, folder, task_id: str | None = TASK) -> dict[str, DataFrame]:
    """The whole session job with filters: the tables it wrote. Without an id the task draws one."""
    task = ALL_DAYS | FILTERS["age"] | FILTERS["sex"]
    written: dict[str, DataFrame] = {}

    def write(df, table):
        path = _scratch(spark, table)
        df.write.parquet(path)
        written[table] = spark.read.parquet(path)

    params = _params(task)
    run_session_job(
        _action_table(spark, folder, params), _users(spark, folder), params, write, task_id, BIG_ALLOWANCE
    )
    return written


@query("session_job")
def _(spark, folder):
    """The rows of all tables, each as one text of its values."""
    shown = None
    for table, df in _session_job(spark, folder).items():
        values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]
        rows = df.select(F.lit(table).alias("result_table"), F.concat_ws("|", *values).alias("row"))
        shown = rows if shown is None else shown.unionByName(rows)
    return shown


@query("session_job_random_task")
def _(spark, folder):
    """Rows of the tables of a task that drew its id, with whether the ids are one and look like one."""
    written = _session_job(spark, folder, None)
    drawn = written[RESULT_TABLES["session_ratio"]].first()["taskid"]
    fixed = (F.col("taskid") == drawn) & F.lit(drawn).rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    shown = None
    for table, df in written.items():
        if table != RESULT_TABLES["session_sample"]:  # the sample is drawn by the task's id
            rows = df.groupBy(F.lit(table).alias("result_table"), fixed.alias("one_uuid")).agg(F.count("*").alias("result_rows"))
            shown = rows if shown is None else shown.unionByName(rows)
    return shown


# --- page flow ------------------------------------------------------------------------------


@query("page_pairs")
def _(spark, folder):
    return funnel.page_pairs(funnel.page_moves(_actions(spark, folder)))


@query("page_pairs_cut_sessions")
def _(spark, folder):
    """The same with most sessions of several actions treated as hot, so that they are cut."""
    return funnel.page_pairs(funnel.page_moves(_actions(spark, folder), hot_rows=2))


@query("page_flow_rates")
def _(spark, folder):
    return funnel.flow_rates(funnel.page_moves(_actions(spark, folder)), ALL_DAYS["targetPageFlow"])


@query("page_flow_rate_string")
def _(spark, folder):
    return funnel.flow_rate_text(funnel.page_moves(_actions(spark, folder)), ALL_DAYS["targetPageFlow"], TASK)


@query("action_gaps")
def _(spark, folder):
    return gaps.action_gaps(_actions(spark, folder))


# --- areas ----------------------------------------------------------------------------------


def _area_clicks(spark, folder) -> DataFrame:
    return area.area_product_clicks(_clicks(spark, folder), _cities(spark, folder))


@query("area_product_clicks")
def _(spark, folder):
    return _area_clicks(spark, folder)


@query("area_products")
def _(spark, folder):
    return area.with_products(_area_clicks(spark, folder), _products(spark, folder))


@query("area_products_sql")
def _(spark, folder):
    return area_products_in_sql(_clicks(spark, folder), _cities(spark, folder), _products(spark, folder))


@query("area_top3_products")
def _(spark, folder):
    products = area.with_products(_area_clicks(spark, folder), _products(spark, folder))
    return area.area_top_products(products, TASK, levels=LEVELS)


@query("area_top3_builtin_cities")
def _(spark, folder):
    """With the built-in city dimension and levels; clicks of cities it does not have are dropped."""
    clicks = area.area_product_clicks(_clicks(spark, folder), city_areas(spark))
    return area.area_top_products(area.with_products(clicks, _products(spark, folder)), TASK)


@query("order_lists_trimmed")
def _(spark, folder):
    """Comma lists with commas at their ends, trimmed, and how often each list occurs."""
    lists = F.concat(F.lit(",,"), F.col("order_category_ids"), F.lit(","))
    trimmed = _actions(spark, folder).where("order_category_ids IS NOT NULL").select(trim_commas(lists).alias("category_ids"))
    return trimmed.groupBy("category_ids").agg(F.count("*").alias("orders"))


# --- advertising, batch ---------------------------------------------------------------------


@query("ad_clicks")
def _(spark, folder):
    clicks = _ad_clicks(spark, folder)
    return clicks.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))


@query("ad_user_daily_counts")
def _(spark, folder):
    return ads.user_daily_counts(_ad_clicks(spark, folder))


@query("ad_blacklist")
def _(spark, folder):
    return ads.users_to_ban(ads.user_daily_counts(_ad_clicks(spark, folder)), BAN_ABOVE)


@query("ad_clicks_allowed")
def _(spark, folder):
    clicks = _ad_clicks(spark, folder)
    banned = ads.users_to_ban(ads.user_daily_counts(clicks), BAN_ABOVE)
    return ads.user_daily_counts(ads.drop_banned(clicks, banned))


@query("ad_city_totals")
def _(spark, folder):
    return ads.city_totals(_ad_clicks(spark, folder))


@query("ad_province_totals")
def _(spark, folder):
    return ads.province_totals(ads.city_totals(_ad_clicks(spark, folder)))


@query("ad_province_top3")
def _(spark, folder):
    return ads.province_top_ads(ads.city_totals(_ad_clicks(spark, folder)))


@query("ad_minute_trend")
def _(spark, folder):
    return ads.minute_trend(_ad_clicks(spark, folder))


@query("ad_last_hour")
def _(spark, folder):
    return ads.last_hour(_ad_clicks(spark, folder))


# --- advertising, streams -------------------------------------------------------------------

_ONCE = {"availableNow": True}


def _keyed(spark, label, schema, rule, keys, value=None) -> KeyedTable:
    day = "date" if "date" in schema.names else None
    return KeyedTable(spark, _scratch(spark, label), schema, rule, keys, value, day)


def _totals_table(spark, rule: str) -> KeyedTable:
    keys = ("date", "province", "city", "adid")
    return _keyed(spark, "city-totals", schemas.AD_CITY_TOTALS, rule, keys, "clickCount")


def _event_piece(ts, low: int, high: int):
    """0, 1 or 2: the third of the time range that an event is in."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.least(F.lit(2), F.floor((micros - low) * 3 / (high - low + 1)).cast("int"))


def _in_pieces(spark, folder, start) -> None:
    """The events in three pieces in order of time, each read by a query that goes on where the last one stopped."""
    events = retail.read(spark, folder, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.coalesce(F.min(micros), F.lit(0)), F.coalesce(F.max(micros), F.lit(0))).first()
    inbox, checkpoint = _scratch(spark, "inbox"), _scratch(spark, "checkpoint")
    for piece in range(3):
        events.where(_event_piece(F.col("ts"), low, high) == piece).write.mode("append").parquet(inbox)
        lines = retail.ad_lines(spark.readStream.schema(events.schema).parquet(inbox), _cities(spark, folder))
        start(lines, checkpoint).awaitTermination()


def _counted_in_pieces(spark, folder, table, count) -> DataFrame:
    _in_pieces(
        spark, folder, lambda lines, checkpoint: running.start_counts(parse_ad_lines(lines), count, table, checkpoint, _ONCE)
    )
    return table.current()


@query("ad_stream_city_totals")
def _(spark, folder):
    return _counted_in_pieces(spark, folder, _totals_table(spark, "add"), ads.city_totals)


@query("ad_stream_top3")
def _(spark, folder):
    totals = _totals_table(spark, "add")
    top = _keyed(spark, "province-top", schemas.AD_PROVINCE_TOP3, "replace_group", ("date", "province"))
    _in_pieces(
        spark,
        folder,
        lambda lines, checkpoint: running.start_province_top_ads(parse_ad_lines(lines), totals, top, checkpoint, _ONCE),
    )
    return top.current()


def _streamed_trend(spark, folder) -> DataFrame:
    keys = ("date", "hour", "minute", "adid")
    table = _keyed(spark, "trend", schemas.AD_TREND, "add", keys, "clickCount")
    return _counted_in_pieces(spark, folder, table, ads.minute_trend)


@query("ad_stream_trend")
def _(spark, folder):
    return _streamed_trend(spark, folder)


@query("ad_stream_sliding_hour")
def _(spark, folder):
    return running.sliding_hours(_streamed_trend(spark, folder))


@query("ad_stream_allowed")
def _(spark, folder):
    """Counts of the job over three pieces: users banned in one are dropped from the next on."""
    tables = AdTables.below(spark, _scratch(spark, "ad-job"))
    _in_pieces(spark, folder, lambda lines, checkpoint: start_ad_job(lines, tables, checkpoint, BAN_ABOVE, _ONCE))
    return tables.user_counts.current()


@query("sink_restart")
def _(spark, folder):
    """Totals of two queries, each with a checkpoint of its own, so both count their batches from 0."""
    table = _totals_table(spark, "add")
    odd = F.minute("ts") % 2 == 1
    for part in (~odd, odd):
        clicks = parse_ad_lines(_ad_line_stream(spark, folder)).where(part)
        running.start_counts(clicks, ads.city_totals, table, _scratch(spark, "checkpoint"), _ONCE).awaitTermination()
    return table.current()


# --- advertising, streams with state --------------------------------------------------------


def _state_totals(spark, folder, finish, trigger: dict | None = _ONCE, fail_at: int | None = None) -> DataFrame:
    """Running totals over three pieces of the events; ``finish`` ends each run. Batch ``fail_at`` fails once, after its write."""
    table, failed = _totals_table(spark, "replace"), []

    def write(rows: DataFrame, batch_id: int) -> None:
        table.apply(rows, batch_id)
        if batch_id == fail_at and not failed:
            failed.append(batch_id)
            raise RuntimeError("a batch that fails once")

    def start(lines, checkpoint):
        return finish(lambda: stateful.start(stateful.running_totals(parse_ad_lines(lines)), "update", checkpoint, write, trigger))

    _in_pieces(spark, folder, start)
    return table.current()


@query("ad_state_totals")
def _(spark, folder):
    return _state_totals(spark, folder, lambda begin: begin())


@query("ad_state_totals_after_failure")
def _(spark, folder):
    """The second batch fails once; the query is started again from its checkpoint."""

    def finish(begin):
        running_query = begin()
        try:
            running_query.awaitTermination()
        except StreamingQueryException:
            running_query = begin()
        return running_query

    return _state_totals(spark, folder, finish, fail_at=1)


@query("ad_state_totals_stopped")
def _(spark, folder):
    """On its trigger of five seconds the query is stopped between batches and started again, for each piece."""

    def finish(begin):
        running_query = begin()
        running_query.processAllAvailable()
        stop_between_batches(running_query)
        return running_query

    return _state_totals(spark, folder, finish, trigger=None)


def _appended(spark, folder, result) -> DataFrame:
    """What an append-mode query over three pieces has given."""
    out = _scratch(spark, "windows")

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")  # a batch that runs again writes the same place

    _in_pieces(spark, folder, lambda lines, checkpoint: stateful.start(result(parse_ad_lines(lines)), "append", checkpoint, write, _ONCE))
    return spark.read.parquet(out).drop("batch")


@query("ad_state_minutes")
def _(spark, folder):
    """Minutes that the watermark, an hour behind the last click, has passed."""
    return _appended(spark, folder, stateful.minute_counts)


@query("ad_state_sliding_hour")
def _(spark, folder):
    """Hours that the watermark has passed."""
    return _appended(spark, folder, stateful.sliding_hours)


@query("ad_state_bans")
def _(spark, folder):
    """Users that the stateful processors have banned, each once."""
    out = _scratch(spark, "bans")

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _in_pieces(
        spark, folder, lambda lines, checkpoint: stateful.start(stateful.ban_users(parse_ad_lines(lines), BAN_ABOVE), "update", checkpoint, write, _ONCE)
    )
    return spark.read.parquet(out).select("userid")


@query("sink_row_files")
def _(spark, folder):
    """The clicks of three pieces through the streaming sink, read back."""
    out = _scratch(spark, "row-files")
    spark.dataSource.register(RowFilesSource)

    def start(lines, checkpoint):
        clicks = parse_ad_lines(lines).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "province", "city", "userid", "adid")
        return clicks.writeStream.format("row_files").option("path", out).option("checkpointLocation", checkpoint).trigger(**_ONCE).start()

    _in_pieces(spark, folder, start)
    return spark.read.format("row_files").option("path", out).schema("ts string, province string, city string, userid long, adid long").load()


def _ad_job(spark, folder) -> AdTables:
    tables = AdTables.below(spark, _scratch(spark, "ad-job"))
    start_ad_job(
        _ad_line_stream(spark, folder), tables, _scratch(spark, "checkpoint"), BAN_ABOVE, _ONCE
    ).awaitTermination()
    return tables


@query("ad_stream_user_counts")
def _(spark, folder):
    return _ad_job(spark, folder).user_counts.current()


@query("ad_stream_blacklist")
def _(spark, folder):
    return _ad_job(spark, folder).blacklist.current()


@query("ad_stream_job_top3")
def _(spark, folder):
    return _ad_job(spark, folder).province_top.current()


# --- sinks ----------------------------------------------------------------------------------


@query("sink_managed_overwrite")
def _(spark, folder):
    table, path = "shoptrail_user_info", _scratch(spark, "user-info")
    users = _users(spark, folder)
    replace_table(users.limit(0), table, _scratch(spark, "user-info"))
    replace_table(users, table, path)
    return spark.read.table(table)


def _in_two_batches(clicks: DataFrame):
    """Clicks by parity of their minute, as two batches that touch the same keys."""
    odd = F.minute("ts") % 2 == 1
    return clicks.where(~odd), clicks.where(odd)


@query("sink_additive_upsert")
def _(spark, folder):
    keys = ("date", "province", "city", "adid")
    table = _keyed(spark, "additive", schemas.AD_CITY_TOTALS, "add", keys, "clickCount")
    first, second = _in_two_batches(_ad_clicks(spark, folder))
    table.apply(ads.city_totals(first), 0)
    table.apply(ads.city_totals(second), 1)
    table.apply(ads.city_totals(second), 1)  # a replay
    return table.current()


@query("sink_replacing_upsert")
def _(spark, folder):
    table = _totals_table(spark, "replace")
    clicks = _ad_clicks(spark, folder)
    table.apply(ads.city_totals(_in_two_batches(clicks)[0]), 0)
    table.apply(ads.city_totals(clicks), 1)
    return table.current()


@query("sink_replace_group")
def _(spark, folder):
    table = _keyed(spark, "groups", schemas.AD_PROVINCE_TOP3, "replace_group", ("date", "province"))
    clicks = _ad_clicks(spark, folder)
    table.apply(ads.province_top_ads(ads.city_totals(_in_two_batches(clicks)[0])), 0)
    table.apply(ads.province_top_ads(ads.city_totals(clicks)), 1)
    return table.current()


@query("sink_insert_if_absent")
def _(spark, folder):
    table = _keyed(spark, "inserts", schemas.AD_BLACKLIST, "insert", ("userid",))
    first, second = _in_two_batches(_ad_clicks(spark, folder))
    table.apply(first.select("userid").distinct(), 0)
    table.apply(second.select("userid").distinct(), 1)
    return table.current()


def all_queries() -> dict[str, Query]:
    return dict(_found)
