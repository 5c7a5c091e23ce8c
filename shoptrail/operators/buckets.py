"""Distribution of sessions over visit-length and step-length buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoptrail import fixed_values as fixed
from shoptrail.functions.numbers import half_up

_LIMITS = {
    "reference": (fixed.VISIT_BUCKETS, fixed.STEP_BUCKETS),
    "closed": (fixed.VISIT_BUCKETS_CLOSED, fixed.STEP_BUCKETS_CLOSED),
}


def _within(column: str, first: int, last: int | None) -> Column:
    return F.col(column) >= first if last is None else F.col(column).between(first, last)


def _bucket_predicates(buckets: str) -> dict[str, Column]:
    visits, steps = _LIMITS[buckets]
    return {f"visit_length_{name}": _within("visit_length", a, b) for name, a, b in visits} | {
        f"step_length_{name}": _within("step_length", a, b) for name, a, b in steps
    }


def _counters(buckets: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("session_count"), *(F.count_if(p).alias(name) for name, p in _bucket_predicates(buckets).items())]


def observed(sessions: DataFrame, buckets: str = "reference") -> tuple[DataFrame, Observation]:
    """``sessions``, and named counters that its first write or other action fills on the way.

    They hold what ``bucket_counts`` gives, without an aggregation of their own. Let the action that fills them be a
    write of these very rows: its tasks then count once each, however often they are tried.
    """
    counters = Observation()
    return sessions.observe(counters, *_counters(buckets)), counters


def counted(spark: SparkSession, counters: Observation, buckets: str = "reference") -> DataFrame:
    """The counters as ``bucket_counts`` would give them. Waits for the action; a plan known to be empty reports nothing."""
    found = counters.get
    names = ["session_count", *_bucket_predicates(buckets)]
    return spark.createDataFrame([tuple(found.get(n) or 0 for n in names)], ", ".join(f"{n} bigint" for n in names))


def bucket_counts(sessions: DataFrame, buckets: str = "reference") -> DataFrame:
    """One row: number of sessions and of sessions in each bucket, in a single aggregation.

    ``buckets="reference"`` leaves 4, 7 and 10 (and one step) out of every bucket;
    ``"closed"`` puts them where the bucket's name says.
    """
    return sessions.agg(*_counters(buckets))


def length_ratios(sessions: DataFrame, task_id: str, buckets: str = "reference") -> DataFrame:
    """One row: number of sessions and the share of each bucket, rounded half up to two digits."""
    return ratios_of(bucket_counts(sessions, buckets), task_id, buckets)


def ratios_of(counts: DataFrame, task_id: str, buckets: str = "reference") -> DataFrame:
    """``length_ratios`` from the row of counts."""
    total = F.greatest(F.col("session_count"), F.lit(1))
    return counts.select(
        F.lit(task_id).alias("taskid"),
        "session_count",
        *(half_up(F.col(name) / total, 2).alias(f"{name}_ratio") for name in _bucket_predicates(buckets)),
    )


def length_buckets(sessions: DataFrame, buckets: str = "reference") -> DataFrame:
    """The same distribution with one row per bucket."""
    return buckets_of(bucket_counts(sessions, buckets), buckets)


def buckets_of(counts: DataFrame, buckets: str = "reference") -> DataFrame:
    """``length_buckets`` from the row of counts."""
    names = list(_bucket_predicates(buckets))
    total = F.greatest(F.col("session_count"), F.lit(1))
    return (
        counts
        .unpivot(["session_count"], names, "bucket", "sessions")
        .select("bucket", "sessions", half_up(F.col("sessions") / total, 2).alias("ratio"))
    )
