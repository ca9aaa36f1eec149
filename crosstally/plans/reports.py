"""The audit reports.

Each one covers all active tenants in a single plan: the tenant is a column and part of every join
and group key. ``since`` is the first day looked at; its default is the one the report is known for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosstally import values
from crosstally.functions.aggregates import concat_distinct
from crosstally.functions.predicates import (
    has_value,
    invoice_not_cancelled,
    is_blank,
    is_created,
    is_live,
    issue_not_cancelled,
    month_of,
    since as on_or_after,
)
from crosstally.operators.grouping import duplicates, members_of
from crosstally.operators.presence import missing_in, present_in, present_in_skewed, shuffled_on
from crosstally.operators.received import kept_with, merged
from crosstally.operators.routing import of_active_tenants, route
from crosstally.operators.totals import compare_totals, totals
from crosstally.plans.registry import report

Tables = Mapping[str, DataFrame]

AMOUNT = "decimal(28,2)"


def _routed_issues(tables: Tables, condition: Column) -> DataFrame:
    """Purchase issues of active tenants that are not cancelled and whose partner has a destination."""
    issues = tables["purchase_issue"].where(issue_not_cancelled() & condition)
    return route(of_active_tenants(issues, tables["tenant_registry"]), tables["partner_map"])


def _with_items(headers: DataFrame, items: DataFrame, header_id: str) -> DataFrame:
    """Items joined to their header, on tenant and document: ids repeat from tenant to tenant.

    The document is compared null-safe, which changes no result since items without one are left out.
    It makes the join shuffle both sides also where tables are bucketed by document, so that a document
    with very many items can be split. The tenant is compared plainly, which lets Spark read only the
    folders of the headers' tenants.
    """
    own = items.where(F.col(header_id).isNotNull()).withColumnsRenamed(
        {"tenant": "_tenant", header_id: "_id"}
    )
    same = (F.col("tenant") == F.col("_tenant")) & shuffled_on(["id"])
    return headers.join(own, same).drop("_tenant", "_id")


def _recent_items(tables: Tables, first_day: date | str, month: str) -> DataFrame:
    """Items of issues, without those known to be of a month before that of ``first_day``.

    Tables that the layouts of :mod:`crosstally.sources.catalog` wrote carry the months of an item's
    issue. The scan then skips what is older, instead of reading all items of all time.
    """
    items = tables["purchase_issue_item"]
    if month not in items.columns:
        return items
    known = F.col(month)
    return items.where(known.isNull() | (known >= F.lit(month_of(first_day)))).drop(
        values.CREATED_MONTH, values.INVOICE_MONTH
    )


# Item codes sent back that the destination never received --------------------------------------


def _ucode_missing(tables: Tables, first_day: date | str, condition: Column) -> DataFrame:
    issues = _routed_issues(tables, on_or_after(first_day) & condition).select(
        "tenant", "id", "partner_detail_id", "dest_tenant"
    )
    code = F.lpad("ucode", values.ITEM_CODE_WIDTH, "0")
    sent = (
        _with_items(
            issues, _recent_items(tables, first_day, values.CREATED_MONTH), "purchase_issue_id"
        )
        .select("tenant", "partner_detail_id", code.alias("ucode"), "dest_tenant")
        .distinct()
    )
    columns = ("tenant", "partner_detail_id", "ucode", "dest_tenant")
    if (codes := kept_with(tables, "received_codes")) is not None:
        on = {"dest_tenant": "tenant", "ucode": "code"}
        return missing_in(sent, merged(codes, "received_codes"), on).select(*columns)
    bought = tables["inward_invoice"].where(
        is_live() & ~F.col("purchase_type").isin(values.RETURN_INVOICES)
    )
    # The destinations' items are all of all time; only the codes that were sent are of interest.
    asked = present_in_skewed(
        tables["inward_invoice_item"].select("tenant", "invoice_id", "code"),
        sent,
        {"tenant": "dest_tenant", "code": "ucode"},
    )
    received = _with_items(bought.select("tenant", "id"), asked, "invoice_id")
    return missing_in(sent, received, {"dest_tenant": "tenant", "ucode": "code"}).select(*columns)


@report
def ucode_missing_dc_not_generated(
    tables: Tables, since: date | str = values.ITEM_CODES_SINCE
) -> DataFrame:
    """Item codes returned without a note that the destination never bought."""
    return _ucode_missing(tables, since, is_blank("debit_note_number"))


@report
def ucode_missing_dc_generated(
    tables: Tables, since: date | str = values.ITEM_CODES_SINCE
) -> DataFrame:
    """Item codes returned with a note that the destination never bought."""
    return _ucode_missing(tables, since, has_value("debit_note_number"))


# References and notes ---------------------------------------------------------------------------


@report
def invalid_invoice_in_pr(
    tables: Tables,
    since: date | str = values.INVOICE_REFERENCES_SINCE,
    excluded_tenants: Sequence[str] = values.UNCHECKED_TENANTS,
) -> DataFrame:
    """Purchase issues whose invoice is not in their own tenant or belongs to another partner.

    Only transfer invoices have to belong to the partner. An invoice without a type is not one.
    """
    issues = _routed_issues(
        tables,
        on_or_after(since)
        & (F.col("pr_type") != values.REGULAR_RETURN)
        & F.col("invoice_id").isNotNull()
        & ~F.col("tenant").isin(list(excluded_tenants)),
    )
    invoices = tables["inward_invoice"].where(F.col("id").isNotNull()).select(
        F.col("tenant").alias("_tenant"),
        F.col("id").alias("_invoice_id"),
        F.lit(True).alias("_found"),
        F.coalesce(F.col("purchase_type").isin(values.TRANSFER_INVOICES), F.lit(False)).alias(
            "_transfer"
        ),
        F.col("partner_detail_id").alias("_partner"),
    )
    other_partner = F.col("_transfer") & ~F.col("_partner").eqNullSafe(F.col("partner_detail_id"))
    return (
        issues.join(
            invoices, (F.col("tenant") == F.col("_tenant")) & shuffled_on(["invoice_id"]), "left"
        )
        .where(F.col("_found").isNull() | other_partner)
        .select(
            "dest_tenant",
            F.col("tenant").alias("source_tenant"),
            F.col("id").alias("purchase_issue_id"),
            "invoice_id",
            "invoice_no",
            "pr_type",
            "invoice_tenant",
            F.col("invoice_tenant").eqNullSafe(F.col("tenant")).alias("is_invoice_tenant_same"),
            "status",
            "debit_note_number",
        )
    )


@report
def dc_created_str_not_created(
    tables: Tables, since: date | str = values.NOTES_SINCE
) -> DataFrame:
    """Notes of issues with at least one item for which the destination has no invoice.

    The notes are made distinct before they are looked up, since one may stand on very many issues.
    An empty note counts as a note here; it is the one report that does not ask for a value.
    """
    issues = _routed_issues(
        tables,
        on_or_after(since, "invoice_date")
        & F.col("debit_note_number").isNotNull()
        & ~F.col("debit_note_number").startswith(values.UNMATCHED_NOTE_PREFIX)
        & (F.col("pr_type") != values.REGULAR_RETURN),
    )
    with_items = present_in(
        issues,
        _recent_items(tables, since, values.INVOICE_MONTH),
        {"tenant": "tenant", "id": "purchase_issue_id"},
    )
    noted = with_items.select(
        "tenant", "partner_detail_id", "debit_note_number", "dest_tenant"
    ).distinct()
    if (notes := kept_with(tables, "received_notes")) is not None:
        invoices = merged(notes, "received_notes")
    else:
        invoices = tables["inward_invoice"].where(invoice_not_cancelled())
    return missing_in(
        noted, invoices, {"dest_tenant": "tenant", "debit_note_number": "invoice_no"}
    ).select(
        F.col("debit_note_number").alias("source_debit_note_number"),
        "dest_tenant",
        F.col("tenant").alias("source_tenant"),
    )


def _return_invoices(tables: Tables, since: date | str) -> DataFrame:
    invoices = tables["inward_invoice"].where(
        on_or_after(since) & F.col("purchase_type").isin(values.RETURN_INVOICES)
    )
    return of_active_tenants(invoices, tables["tenant_registry"])


def _numbered_invoices(tables: Tables, since: date | str) -> DataFrame:
    return (
        _return_invoices(tables, since)
        .where(invoice_not_cancelled())
        .select("tenant", "invoice_no", "id", "status", "created_on", "created_by", "total")
    )


@report(order_by=["tenant", "-total_count", "invoice_no"])
def duplicate_str_inward_invoice(
    tables: Tables, since: date | str = values.DUPLICATES_SINCE
) -> DataFrame:
    """Numbers that more than one return invoice of a tenant has, a row for each.

    The invoices themselves are the rows of :func:`duplicate_str_inward_invoice_members`.
    """
    return (
        _numbered_invoices(tables, since)
        .groupBy("tenant", "invoice_no")
        .agg(
            concat_distinct("status").alias("statuses"),
            F.min("created_on").alias("first_created_on"),
            F.max("created_on").alias("last_created_on"),
            F.sum("total").cast(AMOUNT).alias("total_amount_invoice"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .where(F.col("total_count") > 1)
    )


@report(order_by=["tenant", "-total_count", "invoice_no", "id"])
def duplicate_str_inward_invoice_members(
    tables: Tables, since: date | str = values.DUPLICATES_SINCE
) -> DataFrame:
    """Return invoices whose number occurs more than once in a tenant, a row for each invoice."""
    return duplicates(_numbered_invoices(tables, since), ["tenant", "invoice_no"], "total_count")


def _several_notes(tables: Tables, since: date | str) -> tuple[DataFrame, DataFrame]:
    """Return notes, and the live return invoices with more than one debit note."""
    notes = tables["debitnote"].where(F.col("note_type").isin(values.RETURN_NOTES))
    several = (
        notes.groupBy("tenant", "return_order_id")
        .agg(
            F.countDistinct("debit_note_number").alias("total_debit_note_numbers"),
            F.min("note_type").alias("note_type"),
            F.min("partner_detail_id").alias("partner_detail_id"),
        )
        .where(F.col("total_debit_note_numbers") > 1)
    )
    invoices = _return_invoices(tables, since).where(is_live())
    return notes, present_in(several, invoices, {"tenant": "tenant", "return_order_id": "id"})


@report
def multi_cn_for_str_inward(
    tables: Tables, since: date | str = values.RETURN_INVOICES_SINCE
) -> DataFrame:
    """Live return invoices with more than one debit note, a row for each.

    The notes themselves are the rows of :func:`multi_cn_for_str_inward_notes`.
    """
    _, reported = _several_notes(tables, since)
    return reported.select(
        "return_order_id", "note_type", "partner_detail_id", "total_debit_note_numbers", "tenant"
    )


@report
def multi_cn_for_str_inward_notes(
    tables: Tables, since: date | str = values.RETURN_INVOICES_SINCE
) -> DataFrame:
    """Debit and credit notes of live return invoices with more than one debit note.

    A row is a pair of numbers; ``copies`` says how often the invoice has it.
    """
    notes, reported = _several_notes(tables, since)
    order = ["tenant", "return_order_id"]
    return (
        members_of(notes, reported.select(*order, "total_debit_note_numbers"), order)
        .groupBy(*order, "total_debit_note_numbers", "debit_note_number", "credit_note_number")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@report
def no_cn_for_str_inward(
    tables: Tables, since: date | str = values.RETURN_INVOICES_SINCE
) -> DataFrame:
    """Live return invoices without any return note."""
    notes = tables["debitnote"].where(F.col("note_type").isin(values.RETURN_NOTES))
    invoices = _return_invoices(tables, since).where(is_live())
    return missing_in(invoices, notes, {"tenant": "tenant", "id": "return_order_id"}).select(
        F.col("id").alias("invoice_id"), "invoice_no", "created_on", "tenant"
    )


# Single-table reports ---------------------------------------------------------------------------


@report
def pr_sales_without_note(
    tables: Tables,
    since: date | str = values.SALES_RETURNS_SINCE,
    blank_rule: str = "or",
) -> DataFrame:
    """Sales returns without a note.

    ``blank_rule="literal"`` asks for a note that is NULL and empty at once, which is how the
    report was once written: it finds nothing.
    """
    rules = {
        "or": is_blank("debit_note_number"),
        "literal": F.col("debit_note_number").isNull() & (F.col("debit_note_number") == ""),
    }
    issues = tables["purchase_issue"].where(
        on_or_after(since)
        & (F.col("pr_type") == values.SALES_RETURN)
        & rules[blank_rule]
        & issue_not_cancelled()
    )
    return of_active_tenants(issues, tables["tenant_registry"]).select(
        "tenant",
        F.col("id").alias("purchase_issue_id"),
        "pr_type",
        "debit_note_number",
        "partner_detail_id",
        "created_on",
        "status",
    )


@report
def non_regular_vendor_type(
    tables: Tables, since: date | str = values.VENDORS_SINCE
) -> DataFrame:
    """Created pre-orders of primary and secondary vendors."""
    orders = tables["pre_purchase_issue_order"].where(
        on_or_after(since) & F.col("vendor_type").isin(values.REPORTED_VENDORS) & is_created()
    )
    return of_active_tenants(orders, tables["tenant_registry"]).select(
        "tenant",
        F.col("id").alias("pre_purchase_issue_order_id"),
        "vendor_type",
        "partner_detail_id",
        "created_on",
        "status",
    )


# Totals sent and received -----------------------------------------------------------------------


def compared_totals(
    tables: Tables,
    since: date | str,
    sent_value: str,
    received_value: str,
    sent_total: str,
    received_total: str,
    as_type: str,
) -> DataFrame:
    """What was sent per tenant, partner, item, batch and note against what its destination received.

    The destination side has no date floor, so it would be the whole history. Before its items are
    touched, its invoices are cut down to the numbers that were sent there; no other can match. Tables
    that come with the totals received have them cut down alike, and no items are touched.
    """
    issues = _routed_issues(
        tables,
        on_or_after(since)
        & (F.col("pr_type") != values.REGULAR_RETURN)
        & has_value("debit_note_number"),
    ).select("tenant", "id", "partner_detail_id", "debit_note_number", "dest_tenant")
    sent = totals(
        _with_items(
            issues, _recent_items(tables, since, values.CREATED_MONTH), "purchase_issue_id"
        ),
        ["tenant", "ucode", "batch", "debit_note_number", "partner_detail_id", "dest_tenant"],
        sent_value,
        sent_total,
        as_type,
    )
    numbers = {"tenant": "dest_tenant", "invoice_no": "debit_note_number"}
    received_keys = ["tenant", "code", "batch", "invoice_no"]
    if (kept := kept_with(tables, "received_totals")) is not None:
        received = merged(present_in_skewed(kept, issues, numbers), "received_totals").select(
            *received_keys, F.col(received_value).cast(as_type).alias(received_total)
        )
    else:
        invoices = present_in_skewed(
            tables["inward_invoice"].where(invoice_not_cancelled()).select("tenant", "id", "invoice_no"),
            issues,
            numbers,
        )
        received = totals(
            _with_items(invoices, tables["inward_invoice_item"], "invoice_id"),
            received_keys,
            received_value,
            received_total,
            as_type,
        )
    key = {
        "dest_tenant": "tenant",
        "ucode": "code",
        "batch": "batch",
        "debit_note_number": "invoice_no",
    }
    return compare_totals(sent, received, key, sent_total, received_total, as_type)


def compared_quantities(tables: Tables, since: date | str) -> DataFrame:
    return compared_totals(
        tables,
        since,
        "return_quantity",
        "quantity",
        "totalQuantityInPurchaseIssue",
        "totalQuantityInInwardInvoice",
        "bigint",
    )


@report
def str_return_quantity_diff(
    tables: Tables, since: date | str = values.TOTALS_SINCE
) -> DataFrame:
    """Items whose returned and inwarded quantities differ; ``diff`` is inwarded minus returned."""
    return (
        compared_quantities(tables, since)
        .where(F.col("diff") != 0)
        .select(
            "tenant",
            "ucode",
            "batch",
            "debit_note_number",
            "totalQuantityInPurchaseIssue",
            "totalQuantityInInwardInvoice",
            "diff",
            "dest_tenant",
        )
    )


@report
def str_amount_mismatch(
    tables: Tables,
    since: date | str = values.TOTALS_SINCE,
    tolerance: Decimal = values.AMOUNT_TOLERANCE,
) -> DataFrame:
    """Items whose returned and inwarded amounts are further apart than ``tolerance``.

    Quantities are not looked at, whatever they are.
    """
    return (
        compared_totals(
            tables,
            since,
            "amount",
            "net_amount",
            "totalAmountInPurchaseIssue",
            "totalAmountInInwardInvoice",
            AMOUNT,
        )
        .withColumn("diff", F.abs("diff"))
        .where(F.col("diff") > F.lit(tolerance))
        .select(
            "tenant",
            "ucode",
            "batch",
            "debit_note_number",
            "totalAmountInPurchaseIssue",
            "totalAmountInInwardInvoice",
            "diff",
            "dest_tenant",
        )
    )
