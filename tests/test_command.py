import pytest

from conftest import DAY  # noqa: F401  (puts the repository on the path)
from crosstally import read_report
from crosstally.__main__ import main, parse
from crosstally.sources.catalog import save_by_tenant

QUANTITY = (
    "tenant string, ucode string, batch string, debit_note_number string,"
    " totalQuantityInPurchaseIssue bigint, totalQuantityInInwardInvoice bigint, diff bigint,"
    " dest_tenant string"
)


@pytest.fixture
def root(tables, tmp_path):
    path = str(tmp_path / "tables")
    save_by_tenant(
        tables(
            purchase_issue=[{}],
            purchase_issue_item=[{}],
            pre_purchase_issue_order=[{"id": 1}, {"id": 2, "tenant": "ar002"}],
        ),
        path,
    )
    return path


def test_report(spark, root, tmp_path):
    out = str(tmp_path / "out")
    command = ["report", "str_return_quantity_diff", "--tables", root, "--out", out]
    main(command)
    main([*command, "--append"])
    rows = read_report(spark, out, QUANTITY).collect()
    assert [tuple(row) for row in rows] == [
        ("th001", "000007", "B1", "DC1", 10, 0, -10, "ar002")
    ] * 2
    main([*command, "--since", "2025-09-11"])
    assert read_report(spark, out, QUANTITY).count() == 0


@pytest.mark.parametrize("how", [[], ["--at-once"]])
def test_query(spark, root, tmp_path, how):
    text = tmp_path / "query.sql"
    text.write_text("SELECT id, tenant FROM {pre_purchase_issue_order}")
    out = str(tmp_path / "out")
    main(["query", str(text), "--tables", root, "--out", out, *how])
    rows = read_report(spark, out, "id bigint, tenant string").orderBy("id").collect()
    assert [tuple(row) for row in rows] == [(1, "th001"), (2, "ar002")]


def test_unknown_report(capsys):
    with pytest.raises(SystemExit):
        parse(["report", "nothing", "--tables", "x", "--out", "y"])
    assert "invalid choice" in capsys.readouterr().err


def test_each_tenant_alone_unless_asked(spark, root, tmp_path):
    text = tmp_path / "query.sql"
    text.write_text("SELECT count(*) AS orders FROM {pre_purchase_issue_order}")
    out = str(tmp_path / "out")
    main(["query", str(text), "--tables", root, "--out", out])
    assert sorted(map(tuple, read_report(spark, out, "orders bigint, tenant string").collect())) == [
        (1, "ar002"),
        (1, "th001"),
    ]
    main(["query", str(text), "--tables", root, "--out", out, "--at-once"])
    assert read_report(spark, out, "orders bigint").first().orders == 2


def test_skipped_tenants_end_with_an_error(root, tmp_path, capsys):
    text = tmp_path / "query.sql"
    text.write_text("SELECT nothing FROM {pre_purchase_issue_order}")
    with pytest.raises(SystemExit, match="2 tenants were skipped"):
        main(["query", str(text), "--tables", root, "--out", str(tmp_path / "out")])
    assert "th001" in capsys.readouterr().err


def test_parameters_of_reports(spark, root, tmp_path):
    out = str(tmp_path / "out")
    common = ["--tables", root, "--out", out]
    main(["report", "invalid_invoice_in_pr", *common, "--excluded-tenants", "th001,th002"])
    main(["report", "str_amount_mismatch", *common, "--tolerance", "99.5"])
    assert read_report(spark, out, "diff decimal(28,2)").count() == 1
    main(["report", "str_amount_mismatch", *common, "--tolerance", "100"])
    assert read_report(spark, out, "diff decimal(28,2)").count() == 0
    main(["report", "pr_sales_without_note", *common, "--blank-rule", "literal"])
    with pytest.raises(SystemExit, match="tolerance"):
        main(["report", "pr_sales_without_note", *common, "--tolerance", "1"])


def test_duplicates_are_written_in_order(spark, tables, tmp_path):
    many = [
        {"id": 10 * n + k, "tenant": t, "invoice_no": f"DC{n}", "purchase_type": "ICSReturn"}
        for t in ("th001", "ar002")
        for n, copies in ((1, 2), (2, 4), (3, 2))
        for k in range(copies)
    ]
    save_by_tenant(tables(inward_invoice=many), str(tmp_path / "tables"))
    out = tmp_path / "out"
    main(["report", "duplicate_str_inward_invoice", "--tables", str(tmp_path / "tables"), "--out", str(out)])
    written = "".join(part.read_text() for part in sorted(out.glob("*.csv")))
    rows = [line.split(",") for line in written.splitlines() if not line.startswith("tenant,")]
    assert [(r[0], r[1], r[-1]) for r in rows] == [
        (t, f"DC{n}", str(c)) for t in ("ar002", "th001") for n, c in ((2, 4), (1, 2), (3, 2))
    ]
