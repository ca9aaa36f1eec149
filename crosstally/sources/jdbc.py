"""Reader options for tenants that live in one database each.

``settings`` gives the connection of a database by its upper-case name, as a mapping with ``host``,
``user``, ``password`` and optionally ``port``; a database without an entry uses ``DEFAULT``. The
values can be JSON text, as environment variables hold it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosstally.operators.routing import tenant_registry

DEFAULT = "DEFAULT"
DEFAULT_PORT = 3306


def connection_options(settings: Mapping[str, Mapping | str], database: str, table: str) -> dict:
    """Options for ``spark.read.format("jdbc")``. Rows are streamed, not fetched as a whole."""
    found = settings.get(database.upper()) or settings.get(DEFAULT)
    if not found:
        raise KeyError(f"no connection settings for {database}")
    config = json.loads(found) if isinstance(found, str) else found
    port = config.get("port", DEFAULT_PORT)
    return {
        "url": f"jdbc:mysql://{config['host']}:{port}/{database}?useCursorFetch=true",
        "dbtable": table,
        "user": config["user"],
        "password": config["password"],
        "fetchsize": "10000",
        "pushDownPredicate": "true",
        # The tables store times without a zone.
        "preferTimestampNTZ": "true",
    }


def read_table(
    spark: SparkSession,
    settings: Mapping[str, Mapping | str],
    database: str,
    table: str,
    **options,
) -> DataFrame:
    """One table of one database. Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` as ``options`` to read a large one with several connections."""
    merged = {**connection_options(settings, database, table), **options}
    return spark.read.format("jdbc").options(**merged).load()


def read_tenants(
    spark: SparkSession,
    settings: Mapping[str, Mapping | str],
    tenants: list[str],
    table: str,
    **options,
) -> DataFrame:
    """The same table of every tenant, with the tenant's name as a column."""
    parts = [
        read_table(spark, settings, tenant, table, **options).withColumn("tenant", F.lit(tenant))
        for tenant in tenants
    ]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def read_registry(
    spark: SparkSession, settings: Mapping[str, Mapping | str], database: str, **options
) -> DataFrame:
    return tenant_registry(
        read_table(spark, settings, database, "warehouse", **options),
        read_table(spark, settings, database, "arsenal", **options),
    )
