"""Where the entities come from: Parquet or CSV folders, tables of the metastore, or JDBC."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from crosstally import values
from crosstally.operators import routing
from crosstally.operators.grouping import members_of
from crosstally.sources import databases, jdbc
from crosstally.sources.folders import listed
from crosstally.sources.schemas import DOCUMENT_KEYS, ENTITIES, SCHEMAS, conform, ddl

#: Entities that are no tenant's own.
CENTRAL_ENTITIES = tuple(entity for entity in ENTITIES if entity not in DOCUMENT_KEYS)


class Catalog(Mapping[str, DataFrame]):
    """The entities by name, each read when it is first asked for."""

    def __init__(self, load: Callable[[str], DataFrame], entities: tuple[str, ...] = ENTITIES):
        self._load = load
        self._entities = entities
        self._loaded: dict[str, DataFrame] = {}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._entities:
            raise KeyError(entity)
        if entity not in self._loaded:
            self._loaded[entity] = conform(self._load(entity), entity)
        return self._loaded[entity]

    def __iter__(self) -> Iterator[str]:
        return iter(self._entities)

    def __len__(self) -> int:
        return len(self._entities)

    def __contains__(self, entity: object) -> bool:
        return entity in self._entities

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame]) -> Catalog:
        """The given DataFrames as they are, cast to the entities' columns."""
        return cls(frames.__getitem__, tuple(frames))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Catalog:
        """``root/<entity>``, for example as :func:`save_by_tenant` writes it."""

        def load(entity: str) -> DataFrame:
            try:
                return spark.read.parquet(f"{root}/{entity}")
            except AnalysisException as error:
                # No file was written because no tenant has a row.
                if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                    raise
                return spark.createDataFrame([], ddl(entity))

        return cls(load)

    @classmethod
    def from_csv(cls, spark: SparkSession, root: str, malformed: str = "fail") -> Catalog:
        """``root/<entity>`` with a header line; an empty field is NULL only where it is unquoted.

        A value that is not of its column's type, or a header other than the schema's, is an error. With
        ``malformed="apart"`` rows with such a value, or with too few or too many, are left out instead;
        they are the rows of :func:`malformed_rows`. A header is checked all the same.
        """
        if malformed not in ("fail", "apart"):
            raise ValueError(f"malformed rows can fail or be set apart, not {malformed!r}")

        def load(entity: str) -> DataFrame:
            if malformed == "apart":
                return _permissive(spark, root, entity).where(_is_malformed(entity, False)).drop(_MALFORMED)
            return _csv_reader(spark, ddl(entity)).option("mode", "FAILFAST").csv(f"{root}/{entity}")

        return cls(load)

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str) -> Catalog:
        """Tables of the metastore, for example as :func:`save_by_document` writes them."""
        return cls(lambda entity: spark.table(f"{database}.{entity}"))

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        settings: Mapping[str, Mapping],
        tenants: list[str],
        central: Mapping[str, str],
        partner_map: DataFrame,
        of_entity: Mapping[str, Mapping] | None = None,
        **options,
    ) -> Catalog:
        """One database per tenant, with the registry and the notes in central ones.

        ``central`` names the database of ``warehouse`` and ``arsenal`` as ``registry`` and that of
        ``debitnote`` as ``notes``. See :mod:`crosstally.sources.jdbc` for ``settings``. ``options``
        are for all tables, ``of_entity`` has further ones by entity: large tables are split by
        ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``, and headers and
        items have no column of one name to split them by.
        """

        def load(entity: str) -> DataFrame:
            own = {**options, **(of_entity or {}).get(entity, {})}
            if entity == "partner_map":
                return partner_map
            if entity == "tenant_registry":
                return jdbc.read_registry(spark, settings, central["registry"], **own)
            if entity == "debitnote":
                return jdbc.read_table(spark, settings, central["notes"], entity, **own)
            return jdbc.read_tenants(spark, settings, tenants, entity, **own)

        return cls(load)

    @classmethod
    def from_databases(
        cls,
        spark: SparkSession,
        driver: str,
        settings: Mapping[str, Mapping | str],
        tenants: Sequence[str],
        central: Mapping[str, str],
        partner_map: DataFrame,
        of_entity: Mapping[str, Mapping] | None = None,
        **options,
    ) -> Catalog:
        """As :meth:`from_jdbc`, with one scan for a table of all tenants, whatever their number.

        ``driver`` is a DB-API module; see :mod:`crosstally.sources.databases` for ``settings`` and options.
        """

        def load(entity: str) -> DataFrame:
            own = {**options, **(of_entity or {}).get(entity, {})}
            read = partial(databases.read_databases, spark, driver, settings)
            if entity == "partner_map":
                return partner_map
            if entity == "tenant_registry":
                kinds = [
                    read([central["registry"]], kind, "tenant string, id bigint, is_setup int", constant=None, **own)
                    for kind in ("warehouse", "arsenal")
                ]
                return routing.tenant_registry(*kinds)
            if entity == "debitnote":
                return read([central["notes"]], entity, ddl(entity), constant=None, **own)
            return read(tenants, entity, ddl(entity), **own)

        return cls(load)


_MALFORMED = "_malformed"


def _csv_reader(spark: SparkSession, schema: str) -> DataFrameReader:
    options = {"header": True, "enforceSchema": False, "escape": '"'}
    return spark.read.schema(schema).options(**options)


def _permissive(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All rows of an entity's files, malformed ones with their text in a column of its own."""
    reader = _csv_reader(spark, f"{ddl(entity)}, {_MALFORMED} string").option("columnPruning", False)
    return reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=_MALFORMED).csv(f"{root}/{entity}")


def _is_malformed(entity: str, malformed: bool) -> Column:
    """Whether a row is ``malformed``.

    Spark converts the columns that a query needs and no others. The hash needs all of them, so that
    every query finds the same rows; its remainder is never negative, which Spark doesn't work out.
    """
    text, number = F.col(_MALFORMED), F.pmod(F.xxhash64(*SCHEMAS[entity]), F.lit(2))
    return F.when(text.isNotNull() if malformed else text.isNull(), number) >= 0


def malformed_rows(
    spark: SparkSession, root: str, entities: Sequence[str] | None = None
) -> DataFrame:
    """entity, file, text and parsed of each malformed row of the CSV files under ``root``.

    ``text`` is the line as it is, ``parsed`` what could be read of it, as JSON. ``entities`` are by
    default those that have a folder.
    """
    there = [entity for entity in ENTITIES if entity in listed(spark, root)] if entities is None else entities
    found = [
        _permissive(spark, root, entity)
        .where(_is_malformed(entity, True))
        .select(
            F.lit(entity).alias("entity"),
            F.col("_metadata.file_path").alias("file"),
            F.col(_MALFORMED).alias("text"),
            F.to_json(F.struct(*SCHEMAS[entity])).alias("parsed"),
        )
        for entity in there
    ]
    if not found:
        return spark.createDataFrame([], "entity string, file string, text string, parsed string")
    return reduce(DataFrame.unionByName, found)


def quarantine(spark: SparkSession, root: str, path: str) -> dict[str, int]:
    """Write the malformed rows under ``path``, a folder for each entity, and return how many each has."""
    malformed_rows(spark, root).write.mode("overwrite").partitionBy("entity").parquet(path)
    written = spark.read.schema("file string, text string, parsed string, entity string").parquet(path)
    return {row["entity"]: row["count"] for row in written.groupBy("entity").count().collect()}


def to_save(catalog: Mapping[str, DataFrame], entity: str) -> DataFrame:
    """The rows of an entity; items of issues get the months of their issue.

    Reports with a first day skip items of earlier months by them. An item whose issue is not in the
    catalog gets NULL and is never skipped; of several issues with one id, the latest counts.
    """
    rows = catalog[entity]
    if entity != "purchase_issue_item" or "purchase_issue" not in catalog:
        return rows
    month = lambda column: F.trunc(F.max(column), "month")
    months = (
        catalog["purchase_issue"]
        .groupBy("tenant", F.col("id").alias("purchase_issue_id"))
        .agg(
            month("created_on").alias(values.CREATED_MONTH),
            month("invoice_date").alias(values.INVOICE_MONTH),
        )
    )
    plain = rows.drop(values.CREATED_MONTH, values.INVOICE_MONTH)
    return members_of(plain, months, ["tenant", "purchase_issue_id"], "left")


def save_by_tenant(catalog: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Write each entity as Parquet, partitioned by tenant, so a query of one tenant reads only it.

    The rebalance hint brings a tenant's rows together into files of the advisory size and splits
    a tenant that is much larger than that, so neither small files nor one huge task come out.
    Within a file rows are sorted by time, items by the month of their issue, which lets the date
    floors skip row groups. Append items together with their issues.
    """
    for entity in catalog:
        write_by_tenant(to_save(catalog, entity), entity, f"{root}/{entity}", mode)


def write_by_tenant(rows: DataFrame, name: str, path: str, mode: str = "error") -> None:
    """Write rows as :func:`save_by_tenant` does; central tables aren't partitioned."""
    if name in CENTRAL_ENTITIES:
        rows.write.mode(mode).parquet(path)
        return
    times = [c for c in ("created_on", values.CREATED_MONTH) if c in rows.columns]
    together = rows.hint("rebalance", F.col("tenant")).sortWithinPartitions("tenant", *times)
    together.write.partitionBy("tenant").mode(mode).parquet(path)


def save_by_document(
    catalog: Mapping[str, DataFrame],
    database: str,
    buckets: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write each entity as a table, bucketed by document if ``buckets`` are given.

    The layout is the caller's choice and never the data's. Appending follows the tables that are
    there, whatever ``buckets`` says. Buckets serve SQL that joins headers with items on tenant and
    document and needs no shuffle then; a document with very many items is then read by one task. The
    reports don't rely on buckets: their joins shuffle on any layout, so that Spark can split such a
    document.
    """
    for entity in catalog:
        rows, name = to_save(catalog, entity), f"{database}.{entity}"
        keys = DOCUMENT_KEYS.get(entity)
        wanted = buckets
        if mode == "append" and rows.sparkSession.catalog.tableExists(name):
            wanted = _buckets_of(rows.sparkSession, name)
            there = rows.sparkSession.table(name).columns
            rows = rows.select(*(c if c in rows.columns else F.lit(None).alias(c) for c in there))
        if wanted and keys:
            shuffled = rows.repartition(wanted, *keys)
            writer = shuffled.write.bucketBy(wanted, *keys).sortBy(*keys)
        else:
            writer = rows.write
        writer.mode(mode).saveAsTable(name)


def _buckets_of(spark: SparkSession, table: str) -> int | None:
    """How many buckets a table has, None if it has none."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'")
    found = described.first()
    return int(found.data_type) if found and int(found.data_type) > 0 else None
