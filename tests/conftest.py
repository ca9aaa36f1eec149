from __future__ import annotations

import contextlib
import io
import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crosstally.session import local_session
from crosstally.sources.catalog import Catalog
from crosstally.sources.schemas import SCHEMAS, ddl

DAY = datetime(2025, 9, 10)

#: Rows that no report finds fault with; tests change single columns.
DEFAULTS = {
    "tenant_registry": {"id": 1, "kind": "warehouse", "is_setup": 1},
    "partner_map": {},
    "purchase_issue": {
        "tenant": "th001",
        "id": 1,
        "partner_detail_id": "900",
        "invoice_no": "SI1",
        "pr_type": "ICS_RETURN",
        "invoice_date": DAY,
        "status": "CREATED",
        "debit_note_number": "DC1",
        "created_on": DAY,
    },
    "purchase_issue_item": {
        "tenant": "th001",
        "purchase_issue_id": 1,
        "ucode": "000007",
        "batch": "B1",
        "return_quantity": Decimal(10),
        "amount": Decimal("100.00"),
    },
    "pre_purchase_issue_order": {
        "tenant": "th001",
        "id": 1,
        "vendor_type": "PRIMARY",
        "partner_detail_id": "900",
        "status": "CREATED",
        "created_on": DAY,
    },
    "inward_invoice": {
        "tenant": "ar002",
        "id": 1,
        "invoice_no": "DC1",
        "status": "live",
        "purchase_type": "ICS",
        "partner_detail_id": "900",
        "created_by": "user1",
        "created_on": DAY,
        "total": Decimal("100.00"),
    },
    "inward_invoice_item": {
        "tenant": "ar002",
        "invoice_id": 1,
        "code": "000007",
        "batch": "B1",
        "quantity": Decimal(10),
        "net_amount": Decimal("100.00"),
    },
    "debitnote": {
        "tenant": "ar002",
        "return_order_id": 1,
        "note_type": "ICS_RETURN",
        "partner_detail_id": "900",
        "debit_note_number": "DN1",
        "credit_note_number": "CN1",
    },
}

ARROW = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "timestamp_ntz": pa.timestamp("us"),
    "decimal(18,2)": pa.decimal128(18, 2),
    "decimal(18,3)": pa.decimal128(18, 3),
}

#: th001 sends to ar002 as partner 900; th003 is not set up.
ALWAYS = {
    "tenant_registry": [
        {"tenant": "th001", "id": 11},
        {"tenant": "ar002", "id": 12, "kind": "arsenal"},
        {"tenant": "th003", "id": 13, "is_setup": 0},
    ],
    "partner_map": [{"partner_detail_id": "900", "dest_tenant": "ar002"}],
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        8, memory="6g", name="tests", **{"spark.sql.warehouse.dir": warehouse}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def tables(spark):
    """A catalog of hand-made rows: ``tables(purchase_issue=[{"id": 7}], ...)``."""

    def build(**rows) -> Catalog:
        assert set(rows) <= set(SCHEMAS), rows.keys()

        def load(entity: str):
            schema = SCHEMAS[entity]
            given = rows.get(entity, ALWAYS.get(entity, []))
            unknown = {name for row in given for name in row} - set(schema)
            assert not unknown, unknown
            full = [{**DEFAULTS[entity], **row} for row in given]
            columns = {name: [row.get(name) for row in full] for name in schema}
            types = pa.schema([(name, ARROW[kind]) for name, kind in schema.items()])
            return spark.createDataFrame(pa.table(columns, types), ddl(entity))

        return Catalog(load)

    return build


def values(frame, *columns):
    """The rows of ``frame`` as sorted tuples of ``columns``."""
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


def plan_of(frame, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()
