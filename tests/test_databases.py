"""Tenants' databases as one scan: SQLite files stand for them, which need no server."""

import json
import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual, Not, StringStartsWith
from pyspark.sql.types import StructType

from conftest import plan_of
from crosstally import Catalog
from crosstally.operators import routing
from crosstally.sources import databases
from crosstally.sources.schemas import SCHEMAS, ddl

TENANTS = ["th001", "th002", "ar001"]
ROW = "id bigint, invoice_no string, status string, total decimal(18,2), created_on timestamp_ntz, tenant string"


@pytest.fixture
def files(tmp_path):
    """A database for each tenant; one has no rows."""
    for tenant in TENANTS:
        with sqlite3.connect(tmp_path / f"{tenant}.db") as database:
            database.execute("CREATE TABLE inward_invoice (id, invoice_no, status, total, created_on)")
            rows = [(k if k % 50 else None, f"N{k % 7}", "live" if k % 3 else "LIVE", k / 4, f"2025-09-{1 + k % 28:02} 10:00:00") for k in range(500)]
            if tenant != "ar001":
                database.executemany("INSERT INTO inward_invoice VALUES (?, ?, ?, ?, ?)", rows)
    return {"DEFAULT": {"database": str(tmp_path / "{database}.db")}}


def read(spark, files, **options):
    return databases.read_databases(spark, "sqlite3", files, TENANTS, "inward_invoice", ROW, mark="?", **options)


def test_all_rows_in_one_scan(spark, files):
    rows = read(spark, files)
    assert rows.count() == 1000 and rows.schema == StructType.fromDDL(ROW)
    assert {row.tenant: row.n for row in rows.groupBy("tenant").agg(F.count("*").alias("n")).collect()} == {"th001": 500, "th002": 500}
    assert rows.rdd.getNumPartitions() == 3
    assert plan_of(rows, "formatted").count("BatchScan tenant_databases") == 2  # in the tree and in the list
    one = rows.where("tenant = 'th001' AND id = 9").first()
    assert (one.invoice_no, one.total, str(one.created_on)) == ("N2", Decimal("2.25"), "2025-09-10 10:00:00")


@pytest.mark.parametrize("low, high, parts, n", [(0, 500, 4, 4), (0, 3, 10, 3), (100, 200, 3, 3), (5, 5, 9, 1), (0, 500, 1, 1)])
def test_ranges_of_a_key_have_every_row_once(spark, files, low, high, parts, n):
    rows = read(spark, files, key="id", low=low, high=high, parts=parts)
    assert rows.rdd.getNumPartitions() == 3 * n
    want = sorted(map(tuple, read(spark, files).collect()), key=repr)
    assert sorted(map(tuple, rows.collect()), key=repr) == want


def test_filters_give_the_same_rows(spark, files):
    everything = spark.createDataFrame(read(spark, files).collect(), ROW)
    for condition in (
        "tenant = 'th002' AND id > 490",
        "tenant IN ('th001', 'ar001') AND status = 'live' AND created_on >= DATE '2025-09-20'",
        "tenant = 'nowhere'",
        "id IS NULL OR total < 3",
        "id IS NULL",
        "status != 'live' AND invoice_no IN ('N1', 'N2')",
        "total >= 100.25 AND total <= 101",
        "lower(status) = 'live' AND invoice_no > 'N3'",
    ):
        got = sorted(map(tuple, read(spark, files, key="id", high=500, parts=2).where(condition).collect()), key=repr)
        assert got == sorted(map(tuple, everything.where(condition).collect()), key=repr), condition


def reader(**options):
    given = {"driver": "sqlite3", "table": "t", "settings": "{}", "tenants": json.dumps(TENANTS), "constant": "tenant", **options}
    return databases.TenantReader(given, StructType.fromDDL(ROW))


def test_what_goes_into_a_databases_query():
    one = reader(key="id", low="0", high="10", parts="2")
    filters = [
        In(("tenant",), ["th001", "th009"]),
        IsNotNull(("tenant",)),
        EqualTo(("status",), "live"),
        GreaterThan(("id",), 5),
        GreaterThan(("invoice_no",), "N"),
        LessThanOrEqual(("total",), Decimal("1.5")),
        Not(EqualTo(("status",), "x")),
        StringStartsWith(("invoice_no",), "N"),
    ]
    # Spark applies all but the choice of tenants again; order and inequality of text stay with it alone.
    assert list(one.pushFilters(filters)) == filters[2:]
    assert one.tenants == ["th001"] and one.values == ["live", 5]
    first, second = one.partitions()
    assert one.query(first) == (
        "SELECT `id`, `invoice_no`, `status`, `total`, `created_on` FROM `t`"
        " WHERE (`id` < 5 OR `id` IS NULL) AND `status` = %s AND `id` > %s AND `total` <= 1.5"
    )
    assert "`id` >= 5 AND `status`" in one.query(second)
    assert list(reader(tenants="[]").read(databases.Slice(""))) == []


def test_settings_by_database():
    settings = {"TH001": json.dumps({"database": ":memory:"}), "DEFAULT": {"database": "{database}", "uri": True}}
    one = reader(settings=json.dumps(settings))
    assert one.connect("th001").execute("SELECT 1").fetchone() == (1,)
    with pytest.raises(KeyError, match="no connection settings for th002"):
        reader(settings=json.dumps({"TH001": {}})).connect("th002")


def test_a_catalog_of_databases(spark, tmp_path):
    plain = {"bigint": "INTEGER", "int": "INTEGER"}
    for database in ("th001", "ar002", "registry", "notes"):
        with sqlite3.connect(tmp_path / f"{database}.db") as made:
            tables = {"registry": ["warehouse", "arsenal"], "notes": ["debitnote"]}.get(
                database, [e for e in SCHEMAS if e not in ("tenant_registry", "partner_map", "debitnote")]
            )
            for table in tables:
                columns = SCHEMAS.get(table, {"tenant": "string", "id": "bigint", "is_setup": "int"})
                names = [f"`{c}` {plain.get(kind, '')}" for c, kind in columns.items() if c != "tenant" or database in ("registry", "notes")]
                made.execute(f"CREATE TABLE {table} ({', '.join(names)})")
            if database == "registry":
                made.execute("INSERT INTO warehouse VALUES ('th001', 1, 1)")
                made.execute("INSERT INTO arsenal VALUES ('ar002', 2, 1)")
            elif database != "notes":
                made.execute("INSERT INTO pre_purchase_issue_order VALUES (7, 'PRIMARY', 900, 'CREATED', '2025-09-10 00:00:00')")
    cat = Catalog.from_databases(
        spark, "sqlite3", {"DEFAULT": {"database": str(tmp_path / "{database}.db")}}, ["th001", "ar002"],
        {"registry": "registry", "notes": "notes"}, routing.partner_map(spark, {900: "ar002"}), mark="?",
    )
    assert sorted(map(tuple, cat["tenant_registry"].collect())) == [("ar002", 2, "arsenal", 1), ("th001", 1, "warehouse", 1)]
    orders = cat["pre_purchase_issue_order"]
    assert {(row.tenant, row.partner_detail_id) for row in orders.collect()} == {("th001", "900"), ("ar002", "900")}
    assert cat["debitnote"].count() == 0 and cat["inward_invoice"].columns == list(SCHEMAS["inward_invoice"])
    assert ddl("debitnote")
