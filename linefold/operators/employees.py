"""Employee history load (one narrow stage: scan, filter, append)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.functions.columns import lit_date
from linefold.functions.timewin import window_start
from linefold.sources.tables import replace_partitions

HISTORY_COLUMNS = ("id", "userprincipalname", "date_of_day", "service", "id_store")


def employee_history_rows(src: DataFrame, since: dt.date | None,
                          columns=HISTORY_COLUMNS) -> DataFrame:
    """Rows of the employee source from ``since`` on, in the history's
    columns (by name; the original's by-position append of two columns only
    fits a two-column table, trap 19)."""
    d = src if since is None else src.filter(F.col("date_of_day") >= lit_date(since))
    present = [c for c in columns if c in d.columns]
    return d.select(*present)


def append_employee_history(src: DataFrame, path: str, since: dt.date | None) -> None:
    """Put the window's rows into the history table at ``path``. The days of
    the window are replaced, so running a window again changes nothing."""
    rows = employee_history_rows(src, since)
    replace_partitions(rows, path, tuple(rows.columns), ("date_of_day",))


def run_employees(src: DataFrame, path: str, as_of: dt.datetime, pattern: str = "LAST_24H") -> dt.date:
    """The employee job: the window of the named load pattern, appended;
    returns the first day of the window."""
    since = window_start(pattern, as_of)
    append_employee_history(src, path, since)
    return since


__all__ = ["HISTORY_COLUMNS", "employee_history_rows", "append_employee_history", "run_employees"]
