from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from crosstally import Catalog, run_report
from crosstally.operators import routing
from crosstally.session import shared_folder
from crosstally.sources import jdbc
from crosstally.sources.catalog import malformed_rows, quarantine, save_by_document, save_by_tenant
from crosstally.sources.schemas import DOCUMENT_KEYS, ENTITIES, OPTIONAL, SCHEMAS, conform

SENT = {
    "purchase_issue": [{"id": 1}, {"id": 2, "debit_note_number": "DC2"}],
    "purchase_issue_item": [{"purchase_issue_id": 1}, {"purchase_issue_id": 2}],
    "inward_invoice": [{"id": 1}],
    "inward_invoice_item": [{"invoice_id": 1}],
    "debitnote": [{}],
    "pre_purchase_issue_order": [{}],
}
NOTE = ("tenant", "debit_note_number", "diff")
REPORTED = [("th001", "DC2", -10)]


def test_parquet_by_tenant(spark, tables, tmp_path):
    root = str(tmp_path / "tables")
    save_by_tenant(tables(**SENT), root)
    assert (tmp_path / "tables" / "purchase_issue" / "tenant=th001").is_dir()
    cat = Catalog.from_parquet(spark, root)
    assert set(cat) == set(ENTITIES) and len(cat) == len(ENTITIES)
    report = run_report("str_return_quantity_diff", cat)
    assert values(report, *NOTE) == REPORTED


def test_large_tenant_is_written_as_several_files(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.shuffle.partitions", "16")
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'th001' ELSE concat('ar', id % 40) END AS tenant", "id"
    )
    save_by_tenant({"pre_purchase_issue_order": rows}, str(tmp_path))
    root = tmp_path / "pre_purchase_issue_order"
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in root.glob("tenant=*")}
    assert files.pop("tenant=th001") > 3
    # Eight map tasks that write on their own would leave eight files of each of the others.
    assert len(files) == 20 and sum(files.values()) < 3 * 20
    assert spark.read.parquet(str(root)).count() == 60_000


def test_date_floor_and_columns_reach_the_scan(spark, tables, tmp_path, conf):
    conf("spark.sql.maxMetadataStringLength", "10000")
    root = str(tmp_path / "tables")
    save_by_tenant(tables(**SENT), root)
    plan = plan_of(run_report("no_cn_for_str_inward", Catalog.from_parquet(spark, root)))
    invoices = next(line for line in plan.splitlines() if "GreaterThanOrEqual(created_on" in line)
    assert "In(purchase_type, [ICSReturn,StockTransferReturn])" in invoices
    schema = invoices.split("ReadSchema: ")[1]
    assert "created_by" not in schema and "total" not in schema


def test_csv(spark, tables, tmp_path):
    cat = tables(**SENT)
    for entity in cat:
        cat[entity].write.option("header", True).option("escape", '"').csv(str(tmp_path / entity))
    back = Catalog.from_csv(spark, str(tmp_path))
    assert back["purchase_issue"].schema == cat["purchase_issue"].schema
    assert values(run_report("str_return_quantity_diff", back), *NOTE) == REPORTED


def test_headers_meet_items_without_a_shuffle_when_bucketed(spark, tables, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    save_by_document(tables(**SENT), "bucketed", buckets=4)
    cat = Catalog.from_tables(spark, "bucketed")
    report = run_report("str_return_quantity_diff", cat)
    assert values(report, *NOTE) == REPORTED

    items = cat["inward_invoice_item"].withColumnRenamed("invoice_id", "id")
    joined = cat["inward_invoice"].select("tenant", "id").join(items, ["tenant", "id"])
    assert "Exchange" not in plan_of(joined)
    spark.sql("DROP DATABASE bucketed CASCADE")


@pytest.mark.parametrize("buckets", [None, 4])
def test_appending_follows_the_tables_that_are_there(spark, tables, buckets):
    spark.sql("CREATE DATABASE appended")
    save_by_document(tables(**SENT), "appended", buckets=buckets)
    hot = {**SENT, "inward_invoice_item": [{"batch": f"B{i}"} for i in range(200)]}
    save_by_document(tables(**hot), "appended", buckets=16 if buckets is None else None, mode="append")

    def bucketed(entity):
        rows = spark.sql(f"DESCRIBE EXTENDED appended.{entity}").collect()
        return any(row.col_name == "Num Buckets" and row.data_type == "4" for row in rows)

    assert all(bucketed(entity) == bool(buckets) for entity in DOCUMENT_KEYS)
    assert spark.table("appended.inward_invoice_item").count() == 201
    cat = Catalog.from_tables(spark, "appended")
    assert cat["purchase_issue"].count() == 4
    spark.sql("DROP DATABASE appended CASCADE")


def test_old_items_are_not_read(spark, tables, tmp_path, conf):
    conf("spark.sql.maxMetadataStringLength", "10000")
    first, last, old = datetime(2025, 9, 1), datetime(2025, 8, 31, 23), datetime(2024, 1, 5)
    cat = tables(
        purchase_issue=[
            {"id": 1, "created_on": first, "invoice_date": old},
            {"id": 2, "created_on": last, "invoice_date": first},
            {"id": 3, "created_on": old},
        ],
        purchase_issue_item=[{"purchase_issue_id": k, "batch": f"B{k}"} for k in (1, 2, 3, 4)],
    )
    save_by_tenant(cat, str(tmp_path))
    spark.sql("CREATE DATABASE dated")
    save_by_document(cat, "dated", buckets=2)
    for saved in (Catalog.from_parquet(spark, str(tmp_path)), Catalog.from_tables(spark, "dated")):
        assert saved["purchase_issue_item"].count() == 4
        for name in ("str_return_quantity_diff", "ucode_missing_dc_generated", "dc_created_str_not_created"):
            for since in ("2025-08-31", "2025-09-01", "2023-01-01"):
                given, wanted = run_report(name, saved, since=since), run_report(name, cat, since=since)
                assert values(given, *given.columns) == values(wanted, *wanted.columns), (name, since)
            month = "issue_invoice_month" if name.startswith("dc") else "issue_created_month"
            scans = [x for x in plan_of(given, "formatted").splitlines() if "PushedFilters" in x]
            assert any(f"GreaterThanOrEqual({month},2023-01-01)" in x for x in scans), name
    spark.sql("DROP DATABASE dated CASCADE")


@pytest.mark.parametrize(("line", "whole"), [("th001,x2,1,B,1.000,1.00", False), ("th001,2,1,B,1.000,1.00", True)])
def test_a_bad_value_in_csv_is_an_error(spark, tables, tmp_path, line, whole):
    cat = tables(**SENT)
    for entity in cat:
        cat[entity].write.option("header", True).csv(str(tmp_path / entity))
    folder = tmp_path / "inward_invoice_item"
    (folder / "part-more.csv").write_text("tenant,invoice_id,code,batch,quantity,net_amount\n" + line + "\n")
    rows = Catalog.from_csv(spark, str(tmp_path))["inward_invoice_item"]
    if whole:
        assert rows.count() == 2 and len(rows.collect()) == 2
    else:
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|x2"):
            rows.collect()


def test_partner_map_is_broadcast(spark, tables, tmp_path):
    issues = tables(**SENT)["purchase_issue"].crossJoin(spark.range(50_000)).drop("id")
    issues.withColumn("tray_id", F.uuid()).write.parquet(str(tmp_path / "issues"))
    stored = spark.read.parquet(str(tmp_path / "issues"))
    frame = routing.route(stored, routing.partner_map(spark, {k: "ar002" for k in range(900, 1200)}))
    plan = plan_of(frame)
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan, plan
    assert frame.count() == 100_000


def test_options_by_entity(spark, tables, monkeypatch):
    asked = {}

    def read_table(spark, settings, database, table, **options):
        asked[database, table] = options
        rows = tables(**SENT)[table]
        return rows if database == "notes" else rows.drop("tenant")

    monkeypatch.setattr(jdbc, "read_table", read_table)
    split = {"partitionColumn": "purchase_issue_id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    cat = Catalog.from_jdbc(
        spark,
        SETTINGS,
        tenants=["th001"],
        central={"registry": "central", "notes": "notes"},
        partner_map=routing.partner_map(spark, {}),
        of_entity={"purchase_issue_item": split},
        sessionInitStatement="SET x = 1",
    )
    for entity in ("purchase_issue", "purchase_issue_item", "debitnote"):
        cat[entity]
    assert asked["th001", "purchase_issue"] == {"sessionInitStatement": "SET x = 1"}
    assert asked["th001", "purchase_issue_item"] == {"sessionInitStatement": "SET x = 1", **split}
    assert asked["notes", "debitnote"] == {"sessionInitStatement": "SET x = 1"}


def test_columns_are_cast_and_further_ones_kept(spark):
    rows = spark.createDataFrame(
        [("th001", "5", 900, "x")], "tenant string, id string, partner_detail_id int, note string"
    )
    with pytest.raises(ValueError, match="vendor_type"):
        conform(rows, "pre_purchase_issue_order")
    full = rows.selectExpr(
        "*",
        "'PRIMARY' vendor_type",
        "'CREATED' status",
        "timestamp_ntz'2025-08-01 00:00:00' created_on",
    )
    got = conform(full, "pre_purchase_issue_order")
    assert got.columns == [*SCHEMAS["pre_purchase_issue_order"], "note"]
    assert dict(got.dtypes)["id"] == "bigint"
    assert dict(got.dtypes)["partner_detail_id"] == "string"
    assert OPTIONAL <= set(SCHEMAS["purchase_issue"])


def test_registry(spark):
    warehouses = spark.createDataFrame(
        [("th2", 1, 1), ("th1", 2, 1), ("th3", 3, 0), ("ar9", 4, 1)],
        "tenant string, id bigint, is_setup int",
    )
    arsenals = spark.createDataFrame(
        [("ar1", 1, 1), ("ar1", 0, 0), ("ar1", 5, 1)], "tenant string, id bigint, is_setup int"
    )
    registry = routing.tenant_registry(warehouses, arsenals)
    listed = [tuple(row) for row in routing.listed_tenants(registry).collect()]
    assert listed == [
        ("ar9", "warehouse"),
        ("th1", "warehouse"),
        ("th2", "warehouse"),
        ("ar1", "arsenal"),
        ("ar1", "arsenal"),
    ]
    names = spark.createDataFrame([("th1",), ("th3",), ("ar1",), ("ar9",)], "tenant string")
    found = values(routing.tenant_lookup(names, registry), "tenant", "registry_id")
    assert found == [("ar1", 1), ("ar9", None), ("th1", 2), ("th3", None)]


def test_partner_map_from_a_dict(spark):
    frame = routing.partner_map(spark, {"900": "ar002", 7: "th001"})
    assert values(frame, "partner_detail_id", "dest_tenant") == [("7", "th001"), ("900", "ar002")]


SETTINGS = {
    "TH001": {"host": "one", "user": "u", "password": "p", "port": 3307},
    "DEFAULT": '{"host": "any", "user": "u", "password": "p"}',
}


def test_connection_options():
    own = jdbc.connection_options(SETTINGS, "th001", "purchase_issue")
    assert own["url"] == "jdbc:mysql://one:3307/th001?useCursorFetch=true"
    assert own["dbtable"] == "purchase_issue"
    other = jdbc.connection_options(SETTINGS, "th002", "purchase_issue")
    assert other["url"] == "jdbc:mysql://any:3306/th002?useCursorFetch=true"
    with pytest.raises(KeyError):
        jdbc.connection_options({}, "th001", "purchase_issue")


def test_tenants_are_read_from_their_own_database(spark, tables, monkeypatch):
    asked = []

    def read_table(spark, settings, database, table, **options):
        asked.append((database, table))
        return tables(**SENT)[table].drop("tenant")

    monkeypatch.setattr(jdbc, "read_table", read_table)
    both = spark.createDataFrame([("th001", 1, 1)], "tenant string, id bigint, is_setup int")
    registry = routing.tenant_registry(both, both.where("id = 0"))
    monkeypatch.setattr(jdbc, "read_registry", lambda *_, **__: registry)
    cat = Catalog.from_jdbc(
        spark,
        SETTINGS,
        tenants=["th001", "ar002"],
        central={"registry": "central", "notes": "notes"},
        partner_map=routing.partner_map(spark, {"900": "ar002"}),
    )
    assert values(run_report("str_return_quantity_diff", cat), *NOTE) == REPORTED
    assert ("th001", "purchase_issue") in asked and ("ar002", "inward_invoice_item") in asked


class _Session:
    def __init__(self, **options: str):
        self.conf = {name.replace("_", "."): value for name, value in options.items()}


def test_shared_folder(spark):
    assert shared_folder(_Session(spark_checkpoint_dir="/shared/work/")) == "/shared/work"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(spark_master="yarn"))
    assert shared_folder(spark) == shared_folder(spark)


def test_values_survive_parquet(spark, tables, tmp_path):
    cat = tables(
        purchase_issue_item=[{"return_quantity": Decimal("1.500"), "amount": Decimal("0.01")}],
        inward_invoice=[{"created_on": datetime(2025, 1, 2, 3, 4, 5, 678901)}],
    )
    written = {name: cat[name] for name in ("purchase_issue_item", "inward_invoice")}
    save_by_tenant(written, str(tmp_path))
    back = Catalog.from_parquet(spark, str(tmp_path))
    for entity in ("purchase_issue_item", "inward_invoice"):
        assert back[entity].select(cat[entity].columns).collect() == cat[entity].collect()


# Malformed rows of CSV files set apart ------------------------------------------------------------------


def _items_with_bad_lines(tmp_path):
    folder = tmp_path / "csv" / "inward_invoice_item"
    folder.mkdir(parents=True)
    header = "tenant,invoice_id,code,batch,quantity,net_amount"
    good = [f"ar002,{k},00000{k % 9},B1,{k}.5,1.25" for k in range(300)]
    (folder / "one.csv").write_text("\n".join([header, *good]) + "\n")
    bad = ["ar002,7,000001,B1,many,1.25", "ar002,8,000001,B1", "ar002,9,000001,B1,1,2,3", 'th001,"x, y",000001,B1,1,2']
    (folder / "two.csv").write_text("\n".join([header, good[0], *bad, good[1]]) + "\n")
    orders = tmp_path / "csv" / "pre_purchase_issue_order"
    orders.mkdir()
    (orders / "all.csv").write_text("tenant,id,vendor_type,partner_detail_id,status,created_on\nth001,1,PRIMARY,9,CREATED,2025-09-01 00:00:00\n")
    return str(tmp_path / "csv"), bad


def test_malformed_rows_are_set_apart(spark, tmp_path):
    root, bad = _items_with_bad_lines(tmp_path)
    items = Catalog.from_csv(spark, root, malformed="apart")["inward_invoice_item"]
    assert items.count() == 302 and "_malformed" not in items.columns
    assert items.where("invoice_id IS NULL OR net_amount IS NULL").count() == 0
    assert items.select("tenant").where("tenant = 'th001'").count() == 0
    found = malformed_rows(spark, root).collect()
    assert sorted(row.text for row in found) == sorted(bad)
    assert {row.file.rsplit("/")[-1] for row in found} == {"two.csv"}
    (first,) = (row for row in found if "many" in row.text)
    assert '"invoice_id":7' in first.parsed and "quantity" not in first.parsed

    path = str(tmp_path / "quarantine")
    for _ in range(2):
        assert quarantine(spark, root, path) == {"inward_invoice_item": 4}
    back = spark.read.parquet(f"{path}/entity=inward_invoice_item")
    assert sorted(row.text for row in back.collect()) == sorted(bad)


def test_malformed_rows_fail_by_default(spark, tmp_path):
    root, _ = _items_with_bad_lines(tmp_path)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        Catalog.from_csv(spark, root)["inward_invoice_item"].collect()
    assert Catalog.from_csv(spark, root)["pre_purchase_issue_order"].count() == 1
    with pytest.raises(ValueError, match="set apart"):
        Catalog.from_csv(spark, root, malformed="drop")


def test_nothing_is_set_apart_of_good_files_or_none(spark, tmp_path):
    root, _ = _items_with_bad_lines(tmp_path)
    assert malformed_rows(spark, root, ["pre_purchase_issue_order"]).count() == 0
    assert malformed_rows(spark, str(tmp_path / "absent")).count() == 0
    assert quarantine(spark, str(tmp_path / "absent"), str(tmp_path / "q")) == {}
