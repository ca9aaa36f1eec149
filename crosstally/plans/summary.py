"""Pass or fail per compared item, and counts per tenant and on other levels."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosstally import values
from crosstally.plans.registry import report
from crosstally.plans.reports import compared_quantities


@report
def recon_status(
    tables: Mapping[str, DataFrame], since: date | str = values.TOTALS_SINCE
) -> DataFrame:
    """Every compared quantity with its status and, where it failed, the issue."""
    passed = F.col("diff") == 0
    return compared_quantities(tables, since).select(
        "tenant",
        "ucode",
        "batch",
        "debit_note_number",
        "totalQuantityInPurchaseIssue",
        "totalQuantityInInwardInvoice",
        "diff",
        "dest_tenant",
        F.when(passed, "PASS").otherwise("FAIL").alias("validation_status"),
        F.when(~passed & ~F.col("is_received"), "NOT_INWARDED")
        .when(~passed, "QUANTITY_DIFFERENT")
        .alias("issue"),
    )


@report
def recon_summary(
    tables: Mapping[str, DataFrame], since: date | str = values.TOTALS_SINCE
) -> DataFrame:
    """Items checked and failed per source tenant, with the share that failed."""
    failed = F.count_if(F.col("validation_status") == "FAIL")
    return (
        recon_status(tables, since)
        .groupBy("tenant")
        .agg(F.count(F.lit(1)).alias("checked"), failed.alias("failed"))
        .withColumn("failed_percent", F.round(100.0 * F.col("failed") / F.col("checked"), 2))
    )


#: Levels of :func:`recon_summary_levels` by what they group by.
LEVELS = {
    "all": (),
    "tenant": ("tenant",),
    "pair": ("tenant", "dest_tenant"),
    "issue": ("issue",),
    "tenant_issue": ("tenant", "issue"),
}


@report(order_by=["level", "tenant", "dest_tenant", "issue"])
def recon_summary_levels(
    tables: Mapping[str, DataFrame], since: date | str = values.TOTALS_SINCE
) -> DataFrame:
    """Items checked and failed of all, by source tenant, by pair of tenants and by issue.

    ``level`` says what a row stands for; columns that the level doesn't group by are NULL. Items that
    passed have no issue, which is a row of its own on the levels by issue. ``checked_percent`` is the
    share of all items. The comparison is read once for all levels.
    """
    by = ["tenant", "dest_tenant", "issue"]
    failed = F.count_if(F.col("validation_status") == "FAIL")
    grouped = (
        recon_status(tables, since)
        .groupingSets([[F.col(c) for c in level] for level in LEVELS.values()], *(F.col(c) for c in by))
        .agg(
            F.count(F.lit(1)).alias("checked"),
            failed.alias("failed"),
            *(F.grouping(c).alias(f"_{c}") for c in by),
        )
    )
    level = F.lit(None).cast("string")
    for name, own in LEVELS.items():
        is_level = [F.col(f"_{c}") == F.lit(0 if c in own else 1) for c in by]
        level = F.when(is_level[0] & is_level[1] & is_level[2], name).otherwise(level)
    named = grouped.withColumn("level", level)
    # The one row of all items, for the others' shares; the key is true for every row.
    any_row = F.col("checked") > 0
    total = named.where("level = 'all'").select(any_row.alias("_any"), F.col("checked").alias("_total"))
    return (
        named.withColumn("_any", any_row)
        .join(total, "_any")
        .select(
            "level",
            *by,
            "checked",
            "failed",
            F.round(100.0 * F.col("failed") / F.col("checked"), 2).alias("failed_percent"),
            F.round(100.0 * F.col("checked") / F.col("_total"), 2).alias("checked_percent"),
        )
    )
