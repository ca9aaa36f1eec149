"""The reports by name. A new report is a function from a catalog to a DataFrame, registered here."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Build = Callable[..., DataFrame]

REPORTS: dict[str, Build] = {}

#: The order of a report when it is written, by name; ``-`` stands before a descending column.
ORDERS: dict[str, Sequence[str]] = {}


def report(build: Build | None = None, *, order_by: Sequence[str] = ()) -> Build | Callable:
    """Register ``build(catalog, **parameters)`` under its own name."""
    if build is None:
        return lambda build: report(build, order_by=order_by)
    if build.__name__ in REPORTS:
        raise ValueError(f"there already is a report {build.__name__}")
    REPORTS[build.__name__] = build
    ORDERS[build.__name__] = tuple(order_by)
    return build


def run_report(name: str, catalog: Mapping[str, DataFrame], **parameters) -> DataFrame:
    """The rows of a report, in no order."""
    return REPORTS[name](catalog, **parameters)


def in_report_order(name: str, rows: DataFrame) -> DataFrame:
    """``rows`` of the report in the order in which it is written."""
    order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERS[name]]
    return rows.orderBy(*order) if order else rows
