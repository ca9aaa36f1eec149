"""What destinations received, from the sums that a ledger's runs changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: By table: its keys, and the count that says whether a key is there.
KEYS = {
    "received_codes": (("tenant", "code"), "bought_items"),
    "received_notes": (("tenant", "invoice_no"), "invoices"),
    "received_totals": (("tenant", "code", "batch", "invoice_no"), "items"),
}


def merged(changes: DataFrame, name: str) -> DataFrame:
    """The sums of all runs by key; a key whose count has come down to 0 is gone."""
    keys, count = KEYS[name]
    sums = [F.sum(column).alias(column) for column in changes.columns if column not in keys]
    return changes.groupBy(*keys).agg(*sums).where(F.col(count) > 0)


def kept_with(tables: Mapping[str, DataFrame], name: str) -> DataFrame | None:
    """The changes of a sum that ``tables`` come with, None where they come without."""
    return tables[name] if name in tables else None
