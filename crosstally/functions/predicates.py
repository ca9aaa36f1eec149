"""Row predicates shared by the reports.

All of them keep SQL's three-valued logic: a NULL status or type fails both ``is_live`` and
``not_cancelled``, so the row is left out, as ``NOT IN`` and ``<>`` do.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from crosstally import values


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def has_value(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def _any_case_in(column: str, options: Iterable[str]) -> Column:
    return F.lower(column).isin([option.lower() for option in options])


def issue_not_cancelled(column: str = "status") -> Column:
    return ~_any_case_in(column, values.ISSUE_CANCELLED)


def invoice_not_cancelled(column: str = "status") -> Column:
    return ~_any_case_in(column, values.INVOICE_CANCELLED)


def is_live(column: str = "status") -> Column:
    return _any_case_in(column, [values.LIVE])


def is_created(column: str = "status") -> Column:
    return _any_case_in(column, [values.CREATED])


def since(first_day: date | str, column: str = "created_on") -> Column:
    """On or after ``first_day``. The date literal folds to the column's type, so the scan gets it."""
    if isinstance(first_day, str):
        first_day = date.fromisoformat(first_day)
    return F.col(column) >= F.lit(first_day)


def month_of(day: date | str) -> date:
    """The first day of the month of ``day``."""
    if isinstance(day, str):
        day = date.fromisoformat(day)
    return day.replace(day=1)
