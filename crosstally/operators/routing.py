"""Which tenants are active, and where a partner's goods go.

Neither join carries a broadcast hint. The registry and the map are normally a few hundred rows and
Catalyst broadcasts them because their size is below ``spark.sql.autoBroadcastJoinThreshold``; should
the map outgrow it, the same join becomes a shuffled one whose hot partners AQE splits. This needs a
size that Spark knows: files, saved tables and :func:`partner_map` have one, a JDBC table has not.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosstally import values


def tenant_registry(warehouses: DataFrame, arsenals: DataFrame) -> DataFrame:
    """One registry of both kinds of tenants."""
    return (
        warehouses.select("tenant", "id", "is_setup", F.lit(values.WAREHOUSE).alias("kind"))
        .unionByName(
            arsenals.select("tenant", "id", "is_setup", F.lit(values.ARSENAL).alias("kind"))
        )
    )


def partner_map(spark: SparkSession, destinations: Mapping) -> DataFrame:
    """The destination tenant by partner id, from a mapping of a few hundred entries.

    Made from an Arrow table, whose size Spark knows and by which it decides to broadcast it.
    """
    rows = pa.table(
        {
            "partner_detail_id": pa.array([str(partner) for partner in destinations], pa.string()),
            "dest_tenant": pa.array(list(destinations.values()), pa.string()),
        }
    )
    return spark.createDataFrame(rows)


def active_tenants(registry: DataFrame) -> DataFrame:
    """Tenants that are set up."""
    return registry.where(F.col("is_setup") == 1).select("tenant", "kind")


def listed_tenants(registry: DataFrame) -> DataFrame:
    """Active tenants in listing order: warehouses before arsenals, each by name."""
    return active_tenants(registry).orderBy(F.col("kind") == values.ARSENAL, "tenant")


def of_active_tenants(rows: DataFrame, registry: DataFrame) -> DataFrame:
    return rows.join(active_tenants(registry).select("tenant"), "tenant", "left_semi")


def tenant_lookup(names: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry id of each tenant name, NULL where it is not set up.

    The name decides the kind, so a warehouse registered under an arsenal's name is not found.
    """
    ids = (
        registry.where(F.col("is_setup") == 1)
        .groupBy("kind", "tenant")
        .agg(F.min("id").alias("registry_id"))
    )
    kind = F.when(F.col("tenant").startswith(values.ARSENAL_PREFIX), values.ARSENAL).otherwise(
        values.WAREHOUSE
    )
    return (
        names.select("tenant", kind.alias("kind"))
        .join(ids, ["kind", "tenant"], "left")
        .select("tenant", "kind", "registry_id")
    )


def route(rows: DataFrame, partner_map: DataFrame) -> DataFrame:
    """Add the destination tenant of each row's partner; rows of unmapped partners are left out."""
    return rows.join(
        partner_map.select("partner_detail_id", "dest_tenant"), "partner_detail_id"
    )
