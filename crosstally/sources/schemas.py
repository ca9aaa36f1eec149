"""The entities and their columns. Every entity of a tenant carries the tenant's name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

#: Column types by entity. Partner ids are text because they are compared as text, and times have no
#: zone because the tables they come from store none.
SCHEMAS: dict[str, dict[str, str]] = {
    "tenant_registry": {
        "tenant": "string",
        "id": "bigint",
        "kind": "string",
        "is_setup": "int",
    },
    "partner_map": {
        "partner_detail_id": "string",
        "dest_tenant": "string",
    },
    "purchase_issue": {
        "tenant": "string",
        "id": "bigint",
        "partner_detail_id": "string",
        "tray_id": "string",
        "invoice_id": "bigint",
        "invoice_no": "string",
        "invoice_sequence_type": "string",
        "pr_type": "string",
        "invoice_date": "timestamp_ntz",
        "invoice_tenant": "string",
        "status": "string",
        "debit_note_number": "string",
        "created_on": "timestamp_ntz",
    },
    "purchase_issue_item": {
        "tenant": "string",
        "purchase_issue_id": "bigint",
        "ucode": "string",
        "batch": "string",
        "return_quantity": "decimal(18,3)",
        "amount": "decimal(18,2)",
    },
    "pre_purchase_issue_order": {
        "tenant": "string",
        "id": "bigint",
        "vendor_type": "string",
        "partner_detail_id": "string",
        "status": "string",
        "created_on": "timestamp_ntz",
    },
    "inward_invoice": {
        "tenant": "string",
        "id": "bigint",
        "invoice_no": "string",
        "status": "string",
        "purchase_type": "string",
        "partner_detail_id": "string",
        "created_by": "string",
        "created_on": "timestamp_ntz",
        "total": "decimal(18,2)",
    },
    "inward_invoice_item": {
        "tenant": "string",
        "invoice_id": "bigint",
        "code": "string",
        "batch": "string",
        "quantity": "decimal(18,3)",
        "net_amount": "decimal(18,2)",
    },
    "debitnote": {
        "tenant": "string",
        "return_order_id": "bigint",
        "note_type": "string",
        "partner_detail_id": "string",
        "debit_note_number": "string",
        "credit_note_number": "string",
    },
}

ENTITIES = tuple(SCHEMAS)

#: What destinations received, as :mod:`crosstally.sources.ledger` keeps it, by name.
SUMMARIES: dict[str, dict[str, str]] = {
    "received_codes": {
        "tenant": "string",
        "code": "string",
        "bought_items": "bigint",
    },
    "received_notes": {
        "tenant": "string",
        "invoice_no": "string",
        "invoices": "bigint",
    },
    "received_totals": {
        "tenant": "string",
        "code": "string",
        "batch": "string",
        "invoice_no": "string",
        "quantity": "decimal(28,3)",
        "net_amount": "decimal(28,2)",
        "items": "bigint",
        "bought_items": "bigint",
    },
}

#: The document each row belongs to: rows of a header and of its items that are joined share it.
DOCUMENT_KEYS = {
    "purchase_issue": ("tenant", "id"),
    "purchase_issue_item": ("tenant", "purchase_issue_id"),
    "inward_invoice": ("tenant", "id"),
    "inward_invoice_item": ("tenant", "invoice_id"),
    "debitnote": ("tenant", "return_order_id"),
    "pre_purchase_issue_order": ("tenant", "id"),
}

#: Columns a table may lack; nothing reads them but a query of the user's.
OPTIONAL = {"tray_id", "invoice_sequence_type"}


def ddl(entity: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in _schema(entity).items())


def _schema(entity: str) -> dict[str, str]:
    return SCHEMAS[entity] if entity in SCHEMAS else SUMMARIES[entity]


def conform(rows: DataFrame, entity: str) -> DataFrame:
    """Cast ``rows`` to the columns of ``entity``; further columns are kept behind them.

    A column that already has a fitting type is passed on as it is, so that filters on it still
    reach the scan.
    """
    schema = _schema(entity)
    present = {field.name: field.dataType for field in rows.schema}
    absent = [name for name in schema if name not in present and name not in OPTIONAL]
    if absent:
        raise ValueError(f"{entity} lacks {', '.join(absent)}")
    columns = []
    for name, kind in schema.items():
        if name not in present:
            columns.append(F.lit(None).cast(kind).alias(name))
        elif _fits(present[name], kind):
            columns.append(F.col(name))
        else:
            columns.append(F.col(name).cast(kind).alias(name))
    return rows.select(*columns, *(F.col(f"`{name}`") for name in present if name not in schema))


def _fits(have, want: str) -> bool:
    if want == "timestamp_ntz":
        return isinstance(have, TimestampNTZType | TimestampType)
    whole = have.simpleString() in ("int", "bigint")
    return have.simpleString() == want or (whole and want == "decimal(18,3)")
