"""Random small tables, full of NULLs and near misses, against the reports in SQL."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as driver
from conftest import ARROW
from crosstally import Catalog, run_report
from crosstally.sources.schemas import SCHEMAS, ddl
from crosstally.testbed.oracle import ENTITIES, ORACLE
from test_skew import PLAIN

TENANTS = ["th001", "ar002", "th003", "th024", "xx009"]
PARTNERS = ["900", "901", "902", "903", None]
NOTES = ["DC1", "DC2", "DC3", "dc1", "PE1", "", None]
CODES = ["7", "000007", "8", "1234567", "123456", None]


def random_tables(seed: int, size: int = 150) -> dict[str, pa.Table]:
    rng = random.Random(seed)
    pick = rng.choice

    def day() -> datetime:
        return datetime(1996, 12, 1) + timedelta(hours=rng.randrange(24 * 60))

    def money() -> Decimal | None:
        return pick([None, Decimal(rng.randrange(0, 400)) / 100 + 10])

    def count() -> Decimal | None:
        return pick([None, Decimal(rng.randrange(-8, 20)) / 2])

    states = ["CREATED", "cancelled", "CANCELLED", "Deleted", "live", "LIVE", "draft", None]
    rows = {
        "tenant_registry": [
            {"tenant": "th001", "id": 1, "kind": "warehouse", "is_setup": 1},
            {"tenant": "ar002", "id": 2, "kind": "arsenal", "is_setup": 1},
            {"tenant": "th003", "id": 3, "kind": "warehouse", "is_setup": 0},
            {"tenant": "th024", "id": 4, "kind": "warehouse", "is_setup": 1},
        ],
        "partner_map": [
            {"partner_detail_id": "900", "dest_tenant": "ar002"},
            {"partner_detail_id": "901", "dest_tenant": "th001"},
            {"partner_detail_id": "902", "dest_tenant": "xx009"},
        ],
        "purchase_issue": [
            {
                "tenant": pick(TENANTS),
                "id": i // 3,
                "partner_detail_id": pick(PARTNERS),
                "invoice_id": pick([None, rng.randrange(size)]),
                "invoice_no": f"SI{i}",
                "pr_type": pick(["ICS_RETURN", "PR_SALES", "REGULAR_EASYSOL", None]),
                "invoice_date": day(),
                "invoice_tenant": pick([*TENANTS, None]),
                "status": pick(states),
                "debit_note_number": pick([*NOTES, "DC8", "PE9"]),
                "created_on": day(),
            }
            for i in range(6 * size)
        ],
        "purchase_issue_item": [
            {
                "tenant": pick(TENANTS),
                "purchase_issue_id": rng.randrange(2 * size),
                "ucode": pick(CODES),
                "batch": pick(["B1", "B2", None]),
                "return_quantity": count(),
                "amount": money(),
            }
            for _ in range(8 * size)
        ],
        "pre_purchase_issue_order": [
            {
                "tenant": pick(TENANTS),
                "id": i,
                "vendor_type": pick(["PRIMARY", "SECONDARY", "REGULAR", None]),
                "partner_detail_id": pick(PARTNERS),
                "status": pick(states),
                "created_on": datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 20)),
            }
            for i in range(size)
        ],
        "inward_invoice": [
            {
                "tenant": pick(TENANTS),
                "id": i,
                "invoice_no": pick(NOTES),
                "status": pick(states),
                "purchase_type": pick(
                    ["ICS", "StockTransfer", "ICSReturn", "StockTransferReturn", "REGULAR", None]
                ),
                "partner_detail_id": pick(PARTNERS),
                "created_by": pick(["user1", "user2", None]),
                "created_on": day(),
                "total": money(),
            }
            for i in range(4 * size)
        ],
        "inward_invoice_item": [
            {
                "tenant": pick(TENANTS),
                "invoice_id": rng.randrange(4 * size),
                "code": pick(CODES),
                "batch": pick(["B1", "B2", None]),
                "quantity": count(),
                "net_amount": money(),
            }
            for _ in range(6 * size)
        ],
        "debitnote": [
            {
                "tenant": pick(TENANTS),
                "return_order_id": rng.randrange(4 * size),
                "note_type": pick(["ICS_RETURN", "ST_RETURN", "OTHER", None]),
                "partner_detail_id": pick(PARTNERS),
                "debit_note_number": pick(["DN1", "DN2", "DN3", None]),
                "credit_note_number": pick(["CN1", "CN2", None]),
            }
            for _ in range(60 * size)
        ],
    }
    return {
        entity: pa.table(
            {name: [row.get(name) for row in rows[entity]] for name in schema},
            pa.schema([(name, ARROW[kind]) for name, kind in schema.items()]),
        )
        for entity, schema in SCHEMAS.items()
    }


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("name", sorted(driver.PARAMETERS))
def test_report_equals_sql_on_random_tables(spark, name, seed):
    tables = random_tables(seed)
    cat = Catalog(lambda entity: spark.createDataFrame(tables[entity], ddl(entity)))
    frame = run_report(name, cat, **driver.PARAMETERS[name])
    columns = sorted(frame.columns)
    got = Counter(tuple(row[c] for c in columns) for row in frame.collect())

    connection = duckdb.connect()
    for entity, rows in tables.items():
        connection.register(entity, rows)
    sql = PLAIN + ORACLE[name][len(ENTITIES) :]
    # A total is cut to a whole number, which a cast in this SQL would round instead.
    for side in ("it.return_quantity", "ai.quantity"):
        sql = sql.replace(f"coalesce(sum({side}), 0)", f"trunc(coalesce(sum({side}), 0))")
    result = connection.execute(sql)
    order = [[column[0] for column in result.description].index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert got == expected
    assert got
