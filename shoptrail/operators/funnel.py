"""Page flow: consecutive page pairs and single-step conversion rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.operators.sequence import HOT_ROWS, action_order, add_neighbour


def page_moves(actions: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Every action's page with the next page of its session (null for the last action)."""
    order = action_order(actions)
    needed = actions.select(*dict.fromkeys(["session_id", *order, "page_id"]))
    moves = add_neighbour(
        needed, "session_id", order, {"page_id": "next_page_id"}, 1, hot_rows=hot_rows
    )
    return moves.select("page_id", "next_page_id")


def page_pairs(moves: DataFrame) -> DataFrame:
    """How often each page was followed by each other page."""
    return (
        moves.where("next_page_id IS NOT NULL")
        .groupBy(F.col("page_id").alias("from_page"), F.col("next_page_id").alias("to_page"))
        .agg(F.count(F.lit(1)).alias("moves"))
    )


def flow_pairs(page_flow: str) -> list[str]:
    """``1,2,3`` -> ``["1_2", "2_3"]``: a parameter of a few dozen pages. One page or none has no pairs."""
    pages = [int(page) for page in page_flow.split(",") if page]
    return [f"{a}_{b}" for a, b in zip(pages, pages[1:])]


def _flow_counts(moves: DataFrame, page_flow: str) -> DataFrame:
    """One row: ``start_count`` and the array ``steps`` of (pair, moves, base), in flow order."""
    pairs = flow_pairs(page_flow)
    if not pairs:  # no step, so no row and an empty text
        steps = F.array().cast("array<struct<pair:string,moves:bigint,base:bigint>>")
        return moves.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("start_count"), steps.alias("steps"))
    start = int(page_flow.split(",")[0])
    pair = F.concat_ws("_", F.col("page_id").cast("string"), F.col("next_page_id").cast("string"))
    counted = (
        moves.select(F.when(pair.isin(*pairs), pair).alias("pair"), (F.col("page_id") == start).alias("starts"))
        .where(F.col("pair").isNotNull() | F.col("starts"))
        .groupBy("pair")
        .agg(F.count(F.lit(1)).alias("moves"), F.count_if("starts").alias("starts"))
    )
    # One row per pair of the flow is left, so one map holds them all.
    one = counted.agg(
        F.coalesce(F.sum("starts"), F.lit(0)).alias("start_count"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("pair").isNotNull(), F.struct("pair", "moves")))
        ).alias("found"),
    )
    in_order = F.array(*(F.lit(p) for p in pairs))
    moved = F.transform(in_order, lambda p: F.coalesce(F.try_element_at(F.col("found"), p), F.lit(0)))
    one = one.withColumn("moved", moved)
    base = F.concat(F.array("start_count"), F.slice("moved", 1, len(pairs) - 1))
    return one.withColumn(
        "steps",
        F.arrays_zip(in_order.alias("pair"), F.col("moved").alias("moves"), base.alias("base")),
    )


def _rate(moves: Column, base: Column) -> Column:
    return F.when(base != 0, moves / base)


def flow_rates(moves: DataFrame, page_flow: str) -> DataFrame:
    """One row per step of the flow: its moves relative to those of the step before.

    The first step relates to all actions on the first page. A base of zero gives no rate.
    """
    return _flow_counts(moves, page_flow).select(F.posexplode("steps").alias("step", "s")).select(
        (F.col("step") + 1).cast("bigint").alias("step"),
        F.col("s.pair").alias("pair"),
        F.col("s.moves").alias("moves"),
        F.col("s.base").alias("base"),
        _rate(F.col("s.moves"), F.col("s.base")).alias("rate"),
    )


def flow_rate_text(moves: DataFrame, page_flow: str, task_id: str) -> DataFrame:
    """The rates in one text: ``1_2=0.5|2_3=0.4``."""

    def shown(step: Column) -> Column:
        rate = _rate(step["moves"], step["base"]).cast("string")
        return F.concat(step["pair"], F.lit("="), F.coalesce(rate, F.lit("null")))

    return _flow_counts(moves, page_flow).select(
        F.lit(task_id).alias("taskid"),
        F.array_join(F.transform("steps", shown), "|").alias("convertRate"),
    )
