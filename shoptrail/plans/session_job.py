"""The session job: distribution, sample, top categories, their most active sessions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from shoptrail.fixed_values import RESULT_TABLES, SAMPLE_ALLOWANCE
from shoptrail.operators import buckets, categories, sampling, sessions
from shoptrail.params import TaskParams
from shoptrail.sources.tables import visit_actions
from shoptrail.storage import Staging

Write = Callable[[DataFrame, str], None]


def run_session_job(
    action_table: DataFrame,
    users: DataFrame,
    params: TaskParams,
    write: Write,
    task_id: str | None = None,
    allowance: int = SAMPLE_ALLOWANCE,
    bucket_limits: str = "reference",
) -> str:
    """Run all four analyses and hand each result to ``write(df, table_name)``; returns the task id.

    ``write`` has to store the result at once: staged tables are deleted at the end.
    What several analyses use is computed once and staged: the kept sessions (without their lists),
    their counts per category, and the top categories. The buckets are counted by the write of the kept sessions.
    """
    task_id = task_id or str(uuid.uuid4())
    actions = visit_actions(action_table, params)
    kept = sessions.kept_sessions(actions, users, params)
    per_session = categories.session_category_counts(actions)

    with Staging(action_table.sparkSession, "session-job") as staging:
        rows, counters = buckets.observed(
            kept.select("session_id", "start_time", "visit_length", "step_length"), bucket_limits
        )
        kept = staging.table(rows, "kept-sessions")
        counts = buckets.counted(action_table.sparkSession, counters, bucket_limits)
        write(buckets.ratios_of(counts, task_id, bucket_limits), RESULT_TABLES["session_ratio"])
        write(
            sampling.session_sample(actions, kept, task_id, allowance, seed=task_id),
            RESULT_TABLES["session_sample"],
        )
        per_session = staging.table(sessions.of_sessions(per_session, kept), "session-categories")
        counts = categories.category_counts(per_session)
        top = staging.table(categories.top_categories(counts, task_id), "top-categories")
        write(top, RESULT_TABLES["top_categories"])
        write(
            categories.top_category_sessions(per_session, top, task_id),
            RESULT_TABLES["top_category_sessions"],
        )
    return task_id
