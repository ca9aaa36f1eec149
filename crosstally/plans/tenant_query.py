"""The same SQL on every active tenant, results in one DataFrame.

Tables stand in braces in the text, ``SELECT * FROM {purchase_issue}``, as ``spark.sql`` takes
DataFrames.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import suppress
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosstally.operators.routing import listed_tenants, of_active_tenants
from crosstally.sinks.csv_report import write_report

CENTRAL = ("tenant_registry", "partner_map")

#: Created pre-orders of primary vendors, from a day on.
PRIMARY_PRE_ORDERS = """
SELECT * FROM {pre_purchase_issue_order}
WHERE created_on >= DATE '%s' AND lower(status) = 'created' AND vendor_type = 'PRIMARY'
"""


class _Named(dict):
    """Collects the names a text refers to."""

    def __missing__(self, name: str) -> str:
        self[name] = name
        return name


def _frames(text: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    named = _Named()
    text.format_map(named)
    return {name: tables[name] for name in named}


def tenant_query(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Run ``text`` once over the rows of all active tenants.

    Rows carry their ``tenant``. For SQL that treats rows one by one this is the same as running
    it on each tenant. SQL that aggregates, limits, or joins must name ``tenant`` itself in its
    keys; where it cannot, use :func:`tenant_query_each`.
    """
    frames = {
        name: rows if name in CENTRAL else of_active_tenants(rows, tables["tenant_registry"])
        for name, rows in _frames(text, tables).items()
    }
    return spark.sql(text, **frames)


def tenant_query_each(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    tenants: Sequence[str] | None = None,
    chunk: int = 50,
) -> Iterator[tuple[DataFrame, dict[str, str]]]:
    """Run ``text`` on the rows of each tenant alone.

    Gives results, with ``tenant`` as a column and absent columns as NULL, and what went wrong by tenant;
    a tenant whose query is refused is left out of the result. Most text is one result with one scan of
    each table, see :func:`tenant_query_at_once`. For other text the plan has a branch for every tenant,
    and ``chunk`` tenants make a result, which keeps the plan from growing with their number. Partition
    the tables by tenant then, so that a branch reads only its own files.
    """
    at_once = tenant_query_at_once(spark, text, tables, tenants)
    if at_once is not None:
        yield at_once, {}
        return
    if tenants is None:
        tenants = _listed(tables)
    for start in range(0, len(tenants), chunk):
        yield from _in_branches(spark, text, tables, tenants[start : start + chunk])


def tenant_query_at_once(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    tenants: Sequence[str] | None = None,
) -> DataFrame | None:
    """What ``text`` gives on the rows of each tenant alone, in one plan; None if Spark can't plan it.

    Text that takes the rows of one table one by one gives the same rows for all tenants at once. Any
    other text is put behind the list of tenants as a lateral subquery whose tables are those rows that
    are the tenant's. Spark turns this into joins and groups by tenant: aggregates, limits, joins and
    unions of tenants' tables, each table scanned once. What it refuses to turn (a subquery in a
    condition, a CTE over tenants' tables) is the text's property and not that of the rows.
    """
    frames = _frames(text, tables)
    if takes_rows_one_by_one(spark, text, frames):
        if tenants is None:
            return tenant_query(spark, text, tables)
        if not tenants:
            return None
        return spark.sql(text, **_of_tenants(frames, tenants))
    names = _listed(tables) if tenants is None else list(tenants)
    if not names or not set(frames) - set(CENTRAL):
        return None
    # An Arrow table's size is known to Spark, which broadcasts it by that.
    listed = spark.createDataFrame(pa.table({_OF: pa.array(names, pa.string())}))
    try:
        found = spark.sql(_lateral(text), **_of_tenants(frames, names), **{_LISTED: listed})
        found._jdf.queryExecution().optimizedPlan()
    except (PySparkException, Py4JJavaError):
        return None
    return found.withColumn("tenant", F.col(_OF)).drop(_OF)


#: Names that no text uses for its own: the list of tenants and its column.
_LISTED, _OF = "_listed_tenants", "_tenant_of_the_query"
_TABLE = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def _lateral(text: str) -> str:
    """``text`` on the rows of each listed tenant; the tables in braces stay in braces."""

    def own_rows(table: re.Match) -> str:
        if table[1] in CENTRAL:
            return table[0]
        return f"(SELECT * FROM {table[0]} WHERE tenant = _of.{_OF})"

    inner = _TABLE.sub(own_rows, text)
    return f"SELECT _of.{_OF}, _found.* FROM {{{_LISTED}}} AS _of, LATERAL (\n{inner}\n) AS _found"


def _of_tenants(frames: Mapping[str, DataFrame], tenants: Sequence[str]) -> dict[str, DataFrame]:
    """The tenants' rows; the names are literals, so that only their partitions are read."""
    return {
        name: rows if name in CENTRAL else rows.where(F.col("tenant").isin(list(tenants)))
        for name, rows in frames.items()
    }


def _in_branches(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame], tenants: Sequence[str]
) -> Iterator[tuple[DataFrame, dict[str, str]]]:
    """The result of ``text`` on each tenant's rows, a branch of the plan for each."""
    frames = _frames(text, tables)
    results, failures = [], {}
    for tenant in tenants:
        own = {
            name: rows if name in CENTRAL else rows.where(F.col("tenant") == tenant)
            for name, rows in frames.items()
        }
        try:
            result = spark.sql(text, **own)
        except (AnalysisException, ParseException) as error:
            failures[tenant] = str(error)
            continue
        results.append(result.withColumn("tenant", F.lit(tenant)))
    if results:
        yield reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results), failures
    elif failures:
        yield spark.createDataFrame([], "tenant string"), failures


#: Nodes of a plan that look at one row at a time.
ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "View", "Generate"}


def takes_rows_one_by_one(
    spark: SparkSession, text: str, frames: Mapping[str, DataFrame]
) -> bool:
    """Whether ``text`` only selects and filters rows of one tenants' table and passes on its tenant.

    Decided on the plan of the same text on empty tables. Text that Spark refuses is not such text.
    """
    if len(frames) != 1 or set(frames) & set(CENTRAL):
        return False
    empty = {name: spark.createDataFrame([], rows.schema) for name, rows in frames.items()}
    try:
        plan = spark.sql(text, **empty)._jdf.queryExecution().analyzed()
    except (AnalysisException, ParseException):
        return False
    node = plan
    while node.children().size():
        if node.children().size() > 1 or node.nodeName() not in ROW_BY_ROW or node.subqueries().size():
            return False
        node = node.children().apply(0)

    def tenant_of(plan) -> list:
        out = plan.output()
        found = [out.apply(k) for k in range(out.size())]
        return [column.exprId() for column in found if column.name() == "tenant"]

    ours, theirs = tenant_of(plan), tenant_of(node)
    return len(ours) == 1 and len(theirs) == 1 and ours[0].equals(theirs[0])


def write_tenant_query_each(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    path: str,
    mode: str = "overwrite",
    tenants: Sequence[str] | None = None,
    chunk: int = 50,
) -> dict[str, str]:
    """Write the result of :func:`tenant_query_each` as CSV and return what went wrong by tenant.

    What one plan gives for all tenants is one job. A job that fails writes nothing; its tenants are then
    halved until each of those whose rows the query can't process stands alone, so that they keep no other
    from being written. Only errors of the query are a tenant's: a path that can't be written or a cluster
    that is lost is raised.
    """
    waiting = list(_listed(tables) if tenants is None else tenants)
    failures: dict[str, str] = {}
    together = tenant_query_at_once(spark, text, tables, waiting) is not None
    size = len(waiting) if together else chunk
    chunks = [waiting[start : start + size] for start in range(0, len(waiting), size or 1)]
    while chunks:
        some = chunks.pop(0)
        for rows, refused in tenant_query_each(spark, text, tables, some, len(some)):
            failures |= refused
            accepted = [tenant for tenant in some if tenant not in refused]
            if not accepted:
                continue
            try:
                write_report(rows, path, mode)
                mode = "append"
            except (PySparkException, Py4JJavaError) as error:
                if not _of_the_query(error):
                    raise
                if len(accepted) == 1:
                    failures[accepted[0]] = str(error)
                else:
                    half = len(accepted) // 2
                    chunks[:0] = [accepted[:half], accepted[half:]]
    return failures


def _of_the_query(error: PySparkException | Py4JJavaError) -> bool:
    """Whether an error comes from the text or the rows: its SQL state says so (classes 21, 22, 42)."""
    if isinstance(error, PySparkException):
        return (error.getSqlState() or "")[:2] in ("21", "22", "42")
    cause = error.java_exception
    while cause is not None:
        state = getattr(cause, "getSqlState", None)
        with suppress(Py4JError):
            if state and (state() or "")[:2] in ("21", "22", "42"):
                return True
        cause = cause.getCause()
    return False


def _listed(tables: Mapping[str, DataFrame]) -> list[str]:
    return [row.tenant for row in listed_tenants(tables["tenant_registry"]).collect()]
