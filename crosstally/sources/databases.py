"""One table of all tenants' databases as one scan.

A partition is a tenant's rows, or a range of them by a numeric key, read over a connection of its own.
Filters on the tenant choose partitions; filters that every database understands alike go into its query,
and Spark applies them again: a database may compare text without regard to case.

Any DB-API module serves, by name: ``driver="pymysql"``. ``settings`` are as in
:mod:`crosstally.sources.jdbc`, by upper-case database with ``DEFAULT`` for the others: what the module's
``connect`` is called with. ``{database}`` in a value stands for the database's name::

    {"DEFAULT": {"host": "db", "user": "u", "password": "p", "database": "{database}"}}
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from importlib import import_module

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from crosstally.sources.jdbc import DEFAULT

FORMAT = "tenant_databases"
#: Rows that are brought over, and handed to Spark, in one go.
BATCH = 10_000
_ORDER = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Slice(InputPartition):
    """A tenant's rows with ``low`` <= key < ``high``; the first range has rows without a key too."""

    tenant: str
    low: int | None = None
    high: int | None = None

    def condition(self, key: str | None) -> list[str]:
        """In SQL; the bounds are whole numbers."""
        if key is None or (self.low is None and self.high is None):
            return []
        if self.low is None:
            return [f"(`{key}` < {self.high:d} OR `{key}` IS NULL)"]
        return [f"`{key}` >= {self.low:d}"] + ([] if self.high is None else [f"`{key}` < {self.high:d}"])


def slices(tenants: Sequence[str], low: int, high: int, parts: int) -> list[Slice]:
    """The same ranges for each tenant; the first and the last have no end."""
    if parts < 2 or high <= low:
        return [Slice(tenant) for tenant in tenants]
    cuts = sorted({low + (high - low) * k // parts for k in range(1, parts)} - {low})
    ends = [None, *cuts, None]
    return [Slice(tenant, *ends[k : k + 2]) for tenant in tenants for k in range(len(ends) - 1)]


class TenantDatabases(DataSource):
    """The data source. Its options are those of :func:`read_databases`, as text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> TenantReader:
        return TenantReader(dict(self.options), schema)


class TenantReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: T.StructType):
        self.table, self.driver = options["table"], options["driver"]
        self.mark = options.get("mark", "%s")
        self.settings = json.loads(options["settings"])
        self.tenants: list[str] = json.loads(options["tenants"])
        self.key = options.get("key")
        self.low, self.high = int(options.get("low", 0)), int(options.get("high", 0))
        self.parts = int(options.get("parts", 1))
        self.schema = schema
        #: The column that holds the database's name, which is no column of the table.
        self.constant = options.get("constant")
        self.conditions: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Gives back what Spark has to apply: all but the choice of tenants."""
        for condition in filters:
            if not self._chooses_tenants(condition):
                self._add(condition)
                yield condition

    def _chooses_tenants(self, condition: Filter) -> bool:
        if not self.constant or getattr(condition, "attribute", None) != (self.constant,):
            return False
        if isinstance(condition, IsNotNull):
            return True
        if isinstance(condition, EqualTo):
            wanted = {condition.value}
        elif isinstance(condition, In):
            wanted = set(condition.value)
        else:
            return False
        self.tenants = [tenant for tenant in self.tenants if tenant in wanted]
        return True

    def _add(self, condition: Filter) -> None:
        """Put a condition into the query, where no row that meets it can be missed.

        Equal text is equal in every collation, but its order and what differs depend on it.
        """
        column = getattr(condition, "attribute", ())
        if len(column) != 1 or column[0] == self.constant or column[0] not in self.schema.names:
            return
        text = isinstance(self.schema[column[0]].dataType, T.StringType)
        name = f"`{column[0]}`"
        if isinstance(condition, IsNull | IsNotNull):
            self.conditions.append(f"{name} IS {'NOT ' if isinstance(condition, IsNotNull) else ''}NULL")
        elif isinstance(condition, EqualTo):
            self._compare(f"{name} = ", [condition.value])
        elif isinstance(condition, In) and condition.value:
            self._compare(f"{name} IN ", condition.value)
        elif type(condition) in _ORDER and not text:
            self._compare(f"{name} {_ORDER[type(condition)]} ", [condition.value])

    def _compare(self, start: str, values: Sequence) -> None:
        """A condition on values: numbers of fixed point stand in the query, all others are handed over."""
        if not all(isinstance(value, str | int | float | Decimal | date) for value in values):
            return
        marks = [format(value, "f") if isinstance(value, Decimal) else self.mark for value in values]
        self.conditions.append(start + (f"({', '.join(marks)})" if start.endswith(" IN ") else marks[0]))
        self.values += [str(v) if isinstance(v, date) else v for v in values if not isinstance(v, Decimal)]

    def partitions(self) -> list[Slice]:
        # Spark reads a source without partitions as one that can't be split.
        return slices(self.tenants, self.low, self.high, self.parts) or [Slice("")]

    def query(self, part: Slice) -> str:
        names = ", ".join(f"`{name}`" for name in self.schema.names if name != self.constant)
        conditions = [*part.condition(self.key), *self.conditions]
        return f"SELECT {names} FROM `{self.table}`" + (f" WHERE {' AND '.join(conditions)}" if conditions else "")

    def connect(self, database: str):
        found = self.settings.get(database.upper()) or self.settings.get(DEFAULT)
        if not found:
            raise KeyError(f"no connection settings for {database}")
        given = json.loads(found) if isinstance(found, str) else found
        filled = {k: v.replace("{database}", database) if isinstance(v, str) else v for k, v in given.items()}
        return import_module(self.driver).connect(**filled)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if not partition.tenant:
            return
        fields = [field for field in self.schema if field.name != self.constant]
        arrow = to_arrow_schema(self.schema)
        connection = self.connect(partition.tenant)
        try:
            cursor = connection.cursor()
            cursor.execute(self.query(partition), tuple(self.values))
            while rows := cursor.fetchmany(BATCH):
                columns = {
                    field.name: [_value(value, field.dataType) for value in column]
                    for field, column in zip(fields, zip(*rows, strict=True), strict=True)
                }
                if self.constant:
                    columns[self.constant] = [partition.tenant] * len(rows)
                yield pa.RecordBatch.from_pydict({name: columns[name] for name in arrow.names}, arrow)
        finally:
            connection.close()


def _value(value, kind: T.DataType):
    """A value as its column's type has it; drivers give numbers and times in several forms."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else str(value)
    if isinstance(kind, T.DecimalType):
        return value if isinstance(value, Decimal) else Decimal(str(value))
    if isinstance(kind, T.TimestampNTZType | T.TimestampType) and isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(kind, T.DateType) and isinstance(value, str):
        return date.fromisoformat(value)
    return value


def read_databases(
    spark: SparkSession,
    driver: str,
    settings: Mapping[str, Mapping | str],
    tenants: Sequence[str],
    table: str,
    schema: str,
    *,
    key: str | None = None,
    low: int = 0,
    high: int = 0,
    parts: int = 1,
    constant: str | None = "tenant",
    mark: str = "%s",
) -> DataFrame:
    """The columns of ``schema`` (DDL) of the same table of every tenant's database, in one scan.

    ``constant`` is the column that gets the tenant's name; None for a central table, whose database
    stands in ``tenants``. A large table is read in ``parts`` ranges of the numeric column ``key`` for each
    tenant, cut evenly between ``low`` and ``high``; all rows are read whatever these are. ``mark`` stands
    for a value in the driver's queries. A database that can't be read is an error.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TenantDatabases)
    options = {
        "driver": driver,
        "settings": json.dumps(dict(settings)),
        "tenants": json.dumps(list(tenants)),
        "table": table,
        "low": str(low),
        "high": str(high),
        "parts": str(parts),
        "mark": mark,
    }
    options |= {name: value for name, value in (("key", key), ("constant", constant)) if value}
    return spark.read.format(FORMAT).schema(schema).options(**options).load()
