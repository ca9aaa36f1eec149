"""Reports as CSV: a folder of part files, each with a header line.

What a named run appends is a folder ``run=<name>`` in it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from crosstally.sources.folders import exists, move, remove

#: Quotes inside a value are doubled; NULL and the empty string are both written as nothing.
FORMAT = {"header": True, "escape": '"', "nullValue": "", "emptyValue": ""}

#: A file with line breaks inside values is read by one task, so files are kept small.
ROWS_PER_FILE = 1_000_000


#: Reads the files of runs too, and no others: what is staged is hidden by its name.
EVERYTHING = {"recursiveFileLookup": True}
_RUN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


@dataclass
class Written:
    """What was written: ``counts`` has the rows of each value that was asked for, 0 being one of them."""

    path: str
    rows: int
    counts: dict[str, int] = field(default_factory=dict)


def write_report(
    rows: DataFrame,
    path: str,
    mode: str = "overwrite",
    columns: Sequence[str] | None = None,
    headers: Sequence[str] | None = None,
    run: str | None = None,
) -> str:
    """Write ``rows`` under ``path`` and return it.

    ``columns`` picks and orders columns (one that is absent is left empty), ``headers`` renames
    them by position. Columns with a blank name are dropped. ``mode="append"`` adds to a report
    that is there, by column name; rows with a column it lacks are refused. An empty result gives a
    file with the header alone.

    An append with the name of a ``run`` can be repeated: a run that was added before adds nothing, and
    one that fails leaves nothing, since its files become part of the report by one rename. Two runs may
    be written at once. Overwriting removes all runs with what else is there.
    """
    return write_counted(rows, path, mode, columns, headers, run).path


def write_counted(
    rows: DataFrame,
    path: str,
    mode: str = "overwrite",
    columns: Sequence[str] | None = None,
    headers: Sequence[str] | None = None,
    run: str | None = None,
    count_by: str = "tenant",
    counted: Sequence[str] = (),
) -> Written:
    """:func:`write_report`, and how many rows it wrote, in all and for each value ``counted``.

    The rows are counted as they are written, without another pass. ``count_by`` is the column that has
    the values; rows of others are part of the sum only. A run that was there before writes 0 rows.
    """
    if run is not None and (mode != "append" or not _RUN.fullmatch(run)):
        raise ValueError("a run is appended, and its name has letters, digits, dots, dashes and underscores")
    spark = rows.sparkSession
    if run is not None and exists(spark, f"{path}/run={run}"):
        return Written(path, 0, dict.fromkeys(counted, 0))
    rows = _drop_blank_names(rows)
    seen = Observation()
    each = [F.count_if(F.col(f"`{count_by}`") == value).alias(f"of_{k}") for k, value in enumerate(counted)]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *each)
    if columns is not None:
        rows = _in_order(rows, columns)
    if headers is not None:
        rows = rows.toDF(*headers)
    if mode == "append":
        existing = _columns_of(spark, path)
        if existing:
            extra = [name for name in rows.columns if name not in existing]
            if extra:
                raise ValueError(f"{path} has no column {', '.join(extra)}")
            rows = _in_order(rows, existing)
    target = path if run is None else f"{path}/_staged-{run}"
    if run is not None:
        remove(spark, target)  # what a run of this name that failed has left
    (
        _as_text(rows)
        .write.mode(mode)
        .options(**FORMAT)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(target)
    )
    if run is not None:
        move(spark, target, f"{path}/run={run}")
    found = seen.get
    return Written(path, found["rows"], {value: found[f"of_{k}"] for k, value in enumerate(counted)})


def read_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The report under ``path`` with the columns of ``schema``, which are found by name.

    A column that is missing, and a value that is not of its column's type, is an error.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    there = spark.read.options(**FORMAT, **EVERYTHING).option("multiLine", True).csv(path).columns
    missing = [name for name in schema.names if name not in there]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    as_written = StructType(
        [schema[name] if name in schema.names else StructField(name, StringType()) for name in there]
    )
    rows = (
        spark.read.schema(as_written)
        .options(**FORMAT, **EVERYTHING)
        .options(multiLine=True, mode="FAILFAST", enforceSchema=False)
        .csv(path)
    )
    return rows.select(*(f"`{name}`" for name in schema.names))


def _drop_blank_names(rows: DataFrame) -> DataFrame:
    named = [i for i, name in enumerate(rows.columns) if name.strip()]
    if len(named) == len(rows.columns):
        return rows
    plain = rows.toDF(*(f"_{i}" for i in range(len(rows.columns))))
    return plain.select(*(F.col(f"_{i}").alias(rows.columns[i]) for i in named))


def _in_order(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select(
        *(
            F.col(f"`{name}`") if name in rows.columns else F.lit(None).cast("string").alias(name)
            for name in columns
        )
    )


def _columns_of(spark: SparkSession, path: str) -> list[str]:
    try:
        return spark.read.options(**FORMAT, **EVERYTHING).csv(path).columns
    except AnalysisException as error:
        # No report yet, or a folder in which none was written.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []


def _as_text(rows: DataFrame) -> DataFrame:
    """Times as ``2025-08-26 10:30:00`` and truth values as ``True`` and ``False``."""
    columns = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType | TimestampNTZType):
            column = column.cast("string")
        elif isinstance(field.dataType, BooleanType):
            column = F.initcap(column.cast("string"))
        columns.append(column.alias(field.name))
    return rows.select(*columns)
