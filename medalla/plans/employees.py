"""Employee change events -> type-2 history -> current staff."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.labels import TERMINATION_EVENT
from ..operators import scd2
from . import silver

KEY = "employee_id"
SEQUENCE = "event_at"
HISTORY_COLUMNS = [c for c, _ in silver.EMPLOYEES.columns]


def history(events: DataFrame) -> DataFrame:
    return scd2.build_history(events, KEY, SEQUENCE, HISTORY_COLUMNS)


def collapsed(hist: DataFrame) -> DataFrame:
    """One version for as long as an employee's place stays the same."""
    return scd2.collapse_unchanged(hist, KEY, ["branch_id", "job_title", "event_kind"])


def current(hist: DataFrame) -> DataFrame:
    return scd2.current_rows(hist, "event_kind", TERMINATION_EVENT)
