"""The page job: single-step conversion rates of a page flow."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from shoptrail.fixed_values import RESULT_TABLES
from shoptrail.operators.funnel import flow_rate_text, page_moves
from shoptrail.params import TaskParams
from shoptrail.sources.tables import visit_actions


def run_page_job(
    action_table: DataFrame,
    params: TaskParams,
    write: Callable[[DataFrame, str], None],
    task_id: str | None = None,
) -> str:
    task_id = task_id or str(uuid.uuid4())
    moves = page_moves(visit_actions(action_table, params))
    write(flow_rate_text(moves, params.page_flow, task_id), RESULT_TABLES["page_rates"])
    return task_id
