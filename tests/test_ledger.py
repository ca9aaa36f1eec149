"""A ledger's reports equal those computed from all of its rows, after appends and cancellations."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from conftest import ALWAYS, DEFAULTS, plan_of
from crosstally import Catalog, run_report
from crosstally.operators.received import merged
from crosstally.sources.folders import listed
from crosstally.sources.ledger import Ledger

#: Reports that ask for what a destination received.
REPORTS = [
    "ucode_missing_dc_not_generated",
    "ucode_missing_dc_generated",
    "dc_created_str_not_created",
    "str_return_quantity_diff",
    "str_amount_mismatch",
    "recon_status",
    "recon_summary",
]
SINCE = "2025-09-01"
DAY = datetime(2025, 9, 10)
REGISTRY = [
    {"tenant": "th001"},
    {"tenant": "th002"},
    {"tenant": "ar002", "kind": "arsenal"},
    {"tenant": "th003", "is_setup": 0},
]
PARTNERS = [
    {"partner_detail_id": str(900 + k), "dest_tenant": t} for k, t in enumerate(["ar002", "th001", "th002", "th009"])
]


def rows_of_a_run(rng: random.Random, first: int, invoices: list) -> dict:
    """New issues with their items and new invoices; items also for invoices that were there before."""
    issues, issue_items, headers, items = [], [], [], []
    for number in range(first, first + 25):
        note = rng.choice([None, "", f"DC{rng.randrange(30)}", f"DC{rng.randrange(30)}", f"PE{number}"])
        issues.append(
            {
                "tenant": rng.choice(["th001", "th002", "th003"]),
                "id": number,
                "partner_detail_id": str(900 + rng.randrange(6)),
                "debit_note_number": note,
                "status": rng.choice(["CREATED", "cancelled", None, "DISPATCHED", "CREATED"]),
                "created_on": DAY + timedelta(days=rng.randrange(-40, 40)),
            }
        )
        for _ in range(rng.randrange(4)):
            issue_items.append(
                {
                    "tenant": issues[-1]["tenant"],
                    "purchase_issue_id": number,
                    "ucode": rng.choice(["000001", "1", "000002", "000003", None]),
                    "batch": rng.choice(["B1", "B2", None]),
                    "return_quantity": Decimal(rng.randrange(1, 4)),
                    "amount": rng.choice([None, Decimal(rng.randrange(1, 400)) / 100]),
                }
            )
        headers.append(
            {
                "tenant": rng.choice(["ar002", "th001", "th002", "th009"]),
                "id": number,
                "invoice_no": rng.choice([None, f"DC{rng.randrange(30)}", f"DC{rng.randrange(30)}"]),
                "status": rng.choice(["live", "LIVE", "draft", "CANCELLED", None]),
                "purchase_type": rng.choice(["ICS", "ICSReturn", "StockTransfer", None]),
            }
        )
    invoices += headers
    for _ in range(60):
        owner = rng.choice(invoices)
        items.append(
            {
                "tenant": owner["tenant"],
                "invoice_id": rng.choice([owner["id"]] * 9 + [None, 10**9]),
                "code": rng.choice(["000001", "000002", "000003", "000004", None]),
                "batch": rng.choice(["B1", "B2", None]),
                "quantity": rng.choice([None, Decimal(rng.randrange(1, 4))]),
                "net_amount": Decimal(rng.randrange(1, 400)) / 100,
            }
        )
    return {
        "purchase_issue": issues,
        "purchase_issue_item": issue_items,
        "inward_invoice": headers,
        "inward_invoice_item": items,
    }


def of(catalog, entities):
    return {entity: catalog[entity] for entity in entities}


def report_rows(name, tables):
    return sorted((tuple(map(str, row)) for row in run_report(name, tables, since=SINCE).collect()), key=repr)


def sums(ledger, name):
    return sorted(map(tuple, merged(ledger.catalog()[name], name).collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_reports_after_appends_and_cancellations(spark, tables, tmp_path, seed):
    rng, ledger = random.Random(seed), Ledger(spark, str(tmp_path / "ledger"))
    everything = {"tenant_registry": REGISTRY, "partner_map": PARTNERS}
    central = tables(**everything)
    assert ledger.commit("central", of(central, ["tenant_registry", "partner_map"]))
    invoices: list[dict] = []
    for k in range(4):
        rows = rows_of_a_run(rng, 100 * k, invoices)
        statuses = []
        if k:
            earlier = rng.sample(invoices[:-25], 12)
            statuses = [(h["tenant"], h["id"], rng.choice(["CANCELLED", "live", "Deleted", None])) for h in earlier]
            # Not there; in another tenant; of this run.
            statuses += [("ar002", 10**6, "live"), ("nowhere", earlier[0]["id"], "live")]
            for tenant, number, status in statuses[:12]:
                next(h for h in invoices if (h["tenant"], h["id"]) == (tenant, number))["status"] = status
        frame = spark.createDataFrame(statuses, "tenant string, id bigint, status string") if statuses else None
        assert ledger.commit(f"run-{k}", of(tables(**rows), rows), frame)
        for entity, some in rows.items():
            everything[entity] = everything.get(entity, []) + some
    everything["inward_invoice"] = invoices
    plain = tables(**everything)
    kept = ledger.catalog()
    columns = ["tenant", "id", "status"]
    assert sorted(map(tuple, kept["inward_invoice"].select(columns).collect()), key=repr) == sorted(
        map(tuple, plain["inward_invoice"].select(columns).collect()), key=repr
    )
    for name in REPORTS:
        want = report_rows(name, plain)
        assert report_rows(name, kept) == want and want, name

    # All runs as the first of another ledger: the same sums, computed at once.
    other = Ledger(spark, str(tmp_path / "other"))
    assert other.commit("all", of(kept, [e for e in kept if not e.startswith("received_")]))
    for name in ("received_codes", "received_notes", "received_totals"):
        assert sums(other, name) == sums(ledger, name) and sums(other, name)


def one_invoice(spark, tables, root):
    ledger = Ledger(spark, root)
    cat = tables(
        purchase_issue=[{}],
        purchase_issue_item=[{"return_quantity": Decimal(7)}],
        inward_invoice=[{}],
        inward_invoice_item=[{}],
    )
    assert ledger.commit("first", of(cat, [*ALWAYS, *(e for e in DEFAULTS if e in ("purchase_issue", "purchase_issue_item", "inward_invoice", "inward_invoice_item"))]))
    return ledger, cat


def test_a_run_is_added_once_and_one_that_fails_leaves_nothing(spark, tables, tmp_path, monkeypatch):
    ledger, cat = one_invoice(spark, tables, str(tmp_path))
    assert not ledger.commit("first", of(cat, ["inward_invoice", "inward_invoice_item"]))
    before = sums(ledger, "received_totals")
    assert before == [("ar002", "000007", "B1", "DC1", Decimal("10.000"), Decimal("100.00"), 1, 1)]

    more = of(tables(inward_invoice=[{"id": 2}], inward_invoice_item=[{"invoice_id": 2}]), ["inward_invoice", "inward_invoice_item"])
    with monkeypatch.context() as broken:
        broken.setattr("crosstally.sources.ledger.move", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.commit("second", more)
    assert "_staged-second" in listed(spark, str(tmp_path)) and ledger.runs() == ["first"]
    assert sums(ledger, "received_totals") == before and ledger.catalog()["inward_invoice"].count() == 1

    assert ledger.commit("second", more) and not ledger.commit("second", more)
    assert ledger.catalog()["inward_invoice"].count() == 2
    assert sums(ledger, "received_totals")[0][4:] == (Decimal("20.000"), Decimal("200.00"), 2, 2)
    assert "_staged-second" not in listed(spark, str(tmp_path))


def test_a_cancelled_invoice_is_taken_back_and_one_made_live_again_counts(spark, tables, tmp_path):
    ledger, _ = one_invoice(spark, tables, str(tmp_path))

    def found():
        return [len(report_rows(name, ledger.catalog())) for name in ("dc_created_str_not_created", "ucode_missing_dc_generated")]

    assert found() == [0, 0]
    for run, status, missing in (("a", "CANCELLED", [1, 1]), ("b", "draft", [0, 1]), ("c", "Live", [0, 0])):
        changed = spark.createDataFrame([("ar002", 1, status)], "tenant string, id bigint, status string")
        assert ledger.commit(run, {}, changed)
        assert found() == missing
    (row,) = run_report("str_return_quantity_diff", ledger.catalog(), since=SINCE).collect()
    assert row["diff"] == 3


def test_plans_scan_sums_and_not_the_items_received(spark, tables, tmp_path):
    ledger, _ = one_invoice(spark, tables, str(tmp_path))
    for name in REPORTS:
        plan = plan_of(run_report(name, ledger.catalog(), since=SINCE), "formatted")
        assert "entity=received_" in plan, name
        assert "entity=inward_invoice" not in plan, name


def test_names_and_entities_are_checked(spark, tables, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    for name in ("", "a/b", "_x", "a b"):
        with pytest.raises(ValueError, match="no name"):
            ledger.commit(name, {})
    with pytest.raises(KeyError, match="nothing"):
        ledger.commit("x", {"nothing": tables()["partner_map"]})
    assert ledger.runs() == [] and ledger.catalog()["inward_invoice"].count() == 0


def test_catalogs_without_sums_are_read_as_before(tables):
    assert "received_totals" not in tables() and "received_totals" not in Catalog.of({})
