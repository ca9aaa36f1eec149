import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from conftest import plan_of, values
from crosstally import (
    Catalog,
    read_report,
    tenant_query,
    tenant_query_each,
    write_tenant_query_each,
)
from crosstally.plans import tenant_query as plans
from crosstally.plans.tenant_query import (
    PRIMARY_PRE_ORDERS,
    takes_rows_one_by_one,
    tenant_query_at_once,
)
from crosstally.sources.catalog import save_by_tenant
from crosstally.testbed import star_catalog

ORDERS = {
    "tenant_registry": [
        {"tenant": "th001"},
        {"tenant": "ar002", "kind": "arsenal"},
        {"tenant": "th003", "is_setup": 0},
    ],
    "pre_purchase_issue_order": [
        {"id": 1},
        {"id": 2},
        {"id": 3, "tenant": "ar002"},
        {"id": 4, "tenant": "th003"},
        {"id": 5, "vendor_type": "SECONDARY"},
    ],
}
ROW_WISE = PRIMARY_PRE_ORDERS % "2025-08-01"


def each(spark, text, cat, **options):
    rows, failed = [], {}
    for frame, failures in tenant_query_each(spark, text, cat, **options):
        rows += [row.asDict() for row in frame.collect()]
        failed |= failures
    return rows, failed


def test_both_ways_agree_on_sql_that_takes_rows_one_by_one(spark, tables):
    cat = tables(**ORDERS)
    at_once = tenant_query(spark, ROW_WISE, cat)
    assert values(at_once, "id", "tenant") == [(1, "th001"), (2, "th001"), (3, "ar002")]
    for chunk in (1, 50):
        rows, failed = each(spark, ROW_WISE, cat, chunk=chunk)
        assert not failed
        assert sorted(rows, key=lambda row: row["id"]) == [
            row.asDict() for row in at_once.orderBy("id").collect()
        ]


def test_each_tenant_has_its_own_aggregate_and_limit(spark, tables):
    cat = tables(**ORDERS)
    count = "SELECT count(*) AS orders FROM {pre_purchase_issue_order}"
    assert tenant_query(spark, count, cat).collect()[0].orders == 4
    rows, _ = each(spark, count, cat)
    assert rows == [{"orders": 3, "tenant": "th001"}, {"orders": 1, "tenant": "ar002"}]

    first = "SELECT id FROM {pre_purchase_issue_order} ORDER BY id LIMIT 1"
    assert tenant_query(spark, first, cat).count() == 1
    rows, _ = each(spark, first, cat)
    assert rows == [{"id": 1, "tenant": "th001"}, {"id": 3, "tenant": "ar002"}]


def test_named_tenants_only(spark, tables):
    rows, _ = each(spark, ROW_WISE, tables(**ORDERS), tenants=["ar002"])
    assert [row["id"] for row in rows] == [3]


def test_refused_queries_are_listed_by_tenant(spark, tables):
    rows, failed = each(spark, "SELECT nothing FROM {purchase_issue}", tables(**ORDERS))
    assert rows == [] and set(failed) == {"th001", "ar002"}
    assert "nothing" in failed["th001"]


def test_central_tables_are_whole(spark, tables):
    text = (
        "SELECT o.id, m.dest_tenant FROM {pre_purchase_issue_order} o"
        " JOIN {partner_map} m ON m.partner_detail_id = o.partner_detail_id"
    )
    rows, _ = each(spark, text, tables(**ORDERS))
    assert {row["dest_tenant"] for row in rows} == {"ar002"} and len(rows) == 4


def test_one_tenant_that_fails_keeps_no_other_from_being_written(spark, tables, tmp_path):
    cat = tables(
        tenant_registry=[{"tenant": "th001"}, {"tenant": "th002"}, {"tenant": "th004"}],
        pre_purchase_issue_order=[
            {"id": 1, "tenant": "th001", "vendor_type": "7"},
            {"id": 2, "tenant": "th002", "vendor_type": "PRIMARY"},
            {"id": 3, "tenant": "th004", "vendor_type": "8"},
        ],
    )
    text = "SELECT id, CAST(vendor_type AS INT) AS kind FROM {pre_purchase_issue_order}"
    path = str(tmp_path / "report")
    for _ in range(2):
        failures = write_tenant_query_each(spark, text, cat, path)
        assert set(failures) == {"th002"} and "CAST" in failures["th002"]
        back = read_report(spark, path, "id bigint, kind int, tenant string")
        assert sorted(map(tuple, back.collect())) == [(1, 7, "th001"), (3, 8, "th004")]

    refused = "SELECT nothing FROM {pre_purchase_issue_order}"
    failures = write_tenant_query_each(spark, refused, cat, path, mode="append")
    assert set(failures) == {"th001", "th002", "th004"}


def test_infrastructure_errors_are_not_a_tenants(spark, tables, tmp_path):
    (tmp_path / "file").write_text("not a folder")
    with pytest.raises((PySparkException, Py4JJavaError)):
        write_tenant_query_each(spark, ROW_WISE, tables(**ORDERS), str(tmp_path / "file" / "report"))


@pytest.mark.parametrize(
    ("text", "at_once"),
    [
        (ROW_WISE, True),
        ("SELECT id, tenant, id + 1 AS more FROM {pre_purchase_issue_order} WHERE id > 1", True),
        ("SELECT id FROM {pre_purchase_issue_order}", False),
        ("SELECT id, 'x' AS tenant FROM {pre_purchase_issue_order}", False),
        ("SELECT DISTINCT tenant FROM {pre_purchase_issue_order}", False),
        ("SELECT * FROM {pre_purchase_issue_order} LIMIT 1", False),
        ("SELECT tenant, row_number() OVER (ORDER BY id) AS n FROM {pre_purchase_issue_order}", False),
        ("SELECT * FROM {debitnote} WHERE return_order_id > (SELECT min(id) FROM {debitnote} x)", False),
        ("SELECT a.* FROM {debitnote} a JOIN {debitnote} b ON a.tenant = b.tenant", False),
        ("SELECT * FROM {tenant_registry}", False),
        ("SELECT nothing FROM {debitnote}", False),
    ],
)
def test_text_that_takes_rows_one_by_one(spark, tables, text, at_once):
    cat = tables(**ORDERS)
    frames = {name: cat[name] for name in ("pre_purchase_issue_order", "debitnote", "tenant_registry") if f"{{{name}}}" in text}
    assert takes_rows_one_by_one(spark, text, frames) == at_once


def test_row_wise_text_is_one_scan(spark, tables, tmp_path):
    save_by_tenant(tables(**ORDERS), str(tmp_path))
    ((frame, failures),) = tenant_query_each(spark, ROW_WISE, Catalog.from_parquet(spark, str(tmp_path)), chunk=1)
    assert not failures
    assert plan_of(frame).count("FileScan parquet [id#") == 1
    assert values(frame, "id", "tenant") == [(1, "th001"), (2, "th001"), (3, "ar002")]


# One plan for all tenants, whatever the text does with the rows of each -----------------------------


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("saved"))
    save_by_tenant(star_catalog(spark, "/root/testdata/sf0.001"), root)
    return Catalog.from_parquet(spark, root)


#: Text that Spark plans for all tenants at once, with one scan for each time it names a table.
AT_ONCE = {
    "a sum of all rows": "SELECT count(*) AS n, max(id) AS last FROM {debitnote} d JOIN {inward_invoice} h"
    " ON h.id = d.return_order_id WHERE h.id < 20",
    "groups": "SELECT status, count(*) AS n, sum(total) AS total FROM {inward_invoice} GROUP BY status HAVING count(*) > 3",
    "the greatest of joined groups": "SELECT i.code, sum(i.quantity) AS n, count(DISTINCT h.id) AS invoices"
    " FROM {inward_invoice} h JOIN {inward_invoice_item} AS i ON h.id = i.invoice_id"
    " WHERE lower(h.status) = 'live' GROUP BY i.code ORDER BY n DESC, i.code LIMIT 5",
    "a limit": "SELECT id, tenant FROM {purchase_issue} ORDER BY id DESC LIMIT 2",
    "an offset": "SELECT id FROM {purchase_issue} ORDER BY id LIMIT 2 OFFSET 1",
    "a limit within": "SELECT count(*) AS n FROM (SELECT * FROM {inward_invoice} ORDER BY id LIMIT 3)",
    "distinct rows": "SELECT DISTINCT pr_type FROM {purchase_issue}",
    "a union": "SELECT id, 'i' AS kind FROM {inward_invoice} WHERE id < 50"
    " UNION ALL SELECT id, 'p' FROM {purchase_issue} WHERE id < 50",
    "a union of distinct rows": "SELECT status FROM {inward_invoice} UNION SELECT status FROM {purchase_issue}",
    "numbered rows": "SELECT id, row_number() OVER (ORDER BY id) AS n FROM {inward_invoice}",
    "a group of groups": "SELECT kind, max(n) AS most FROM (SELECT status AS kind, purchase_type, count(*) AS n"
    " FROM {inward_invoice} GROUP BY status, purchase_type) GROUP BY kind",
    "a central table": "SELECT m.dest_tenant, count(*) AS n FROM {purchase_issue} p"
    " JOIN {partner_map} m ON m.partner_detail_id = p.partner_detail_id GROUP BY m.dest_tenant",
    "rows without a tenant": "SELECT id, status FROM {inward_invoice} -- all of them",
}


def sorted_rows(frame):
    return sorted((tuple(sorted(row.asDict().items())) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("kind", sorted(AT_ONCE))
def test_one_plan_gives_what_a_branch_for_each_tenant_gives(spark, saved, conf, kind):
    # Its filters stand in the plan with the scan of the table they come from, which isn't read for them.
    conf("spark.sql.optimizer.dynamicPartitionPruning.enabled", "false")
    # One of the tenants has no rows at all.
    text, tenants = AT_ONCE[kind], [*plans._listed(saved), "th777"]
    at_once = tenant_query_at_once(spark, text, saved, tenants)
    ((branches, failures),) = plans._in_branches(spark, text, saved, tenants)
    assert not failures and at_once.columns == branches.columns
    assert sorted_rows(at_once) == sorted_rows(branches)
    scans = re.findall(r"(?<!Local)Relation \[", at_once._jdf.queryExecution().optimizedPlan().toString())
    assert len(scans) == len(re.findall(r"\{\w+\}", text))


@pytest.mark.parametrize(
    "text",
    [
        "SELECT id FROM {inward_invoice} WHERE total > (SELECT avg(total) FROM {inward_invoice})",
        "SELECT id FROM {inward_invoice} WHERE id IN (SELECT return_order_id FROM {debitnote})",
        "SELECT status, count(*) AS n FROM {inward_invoice} GROUP BY ROLLUP(status)",
        "SELECT h.id FROM {inward_invoice} h LEFT SEMI JOIN {debitnote} d ON d.return_order_id = h.id",
        "SELECT h.id, d.note_type FROM {inward_invoice} h LEFT JOIN {debitnote} d ON d.return_order_id = h.id",
    ],
)
def test_text_that_has_no_one_plan_still_runs_on_each_tenant(spark, saved, text):
    tenants = ["th000", "ar001", "th777"]
    assert tenant_query_at_once(spark, text, saved, tenants) is None
    rows, failures = each(spark, text, saved, tenants=tenants, chunk=2)
    want = [
        {**row.asDict(), "tenant": tenant}
        for tenant in tenants
        for row in spark.sql(text, **{e: saved[e].where(f"tenant = '{tenant}'") for e in set(re.findall(r"\{(\w+)\}", text))}).collect()
    ]
    assert not failures and sorted(map(repr, rows)) == sorted(map(repr, want))


def test_the_list_of_tenants_is_broadcast(spark, saved):
    rows = tenant_query_at_once(spark, "SELECT id, status FROM {inward_invoice}", saved)
    plan = plan_of(rows)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_no_column_of_the_tenants_list_is_seen_by_the_text(spark, saved):
    text = "SELECT tenant FROM {partner_map} JOIN {debitnote} d ON d.partner_detail_id = nothing"
    assert tenant_query_at_once(spark, text, saved, ["th000"]) is None


def test_aggregates_are_written_in_one_job_and_failing_tenants_are_found(spark, tables, tmp_path):
    names = [f"th{k:03}" for k in range(9)]
    cat = tables(
        tenant_registry=[{"tenant": name} for name in names],
        pre_purchase_issue_order=[
            {"id": k, "tenant": name, "vendor_type": "x" if k in (2, 7) else "7"} for k, name in enumerate(names)
        ],
    )
    text = "SELECT sum(CAST(vendor_type AS INT)) AS total FROM {pre_purchase_issue_order}"
    path = str(tmp_path / "report")
    assert set(write_tenant_query_each(spark, text, cat, path)) == {"th002", "th007"}
    back = read_report(spark, path, "total bigint, tenant string")
    assert sorted(map(tuple, back.collect())) == [(7, name) for k, name in enumerate(names) if k not in (2, 7)]
