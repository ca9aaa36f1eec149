"""Cross-tenant reconciliation of purchase returns, inward invoices and notes on Spark."""

from crosstally.plans import reports, summary  # noqa: F401  (they register themselves)
from crosstally.plans.registry import REPORTS, in_report_order, report, run_report
from crosstally.plans.tenant_query import tenant_query, tenant_query_each, write_tenant_query_each
from crosstally.sinks.csv_report import Written, read_report, write_counted, write_report
from crosstally.sources.catalog import Catalog, malformed_rows, quarantine
from crosstally.sources.ledger import Ledger

__all__ = [
    "Catalog",
    "Ledger",
    "REPORTS",
    "Written",
    "in_report_order",
    "malformed_rows",
    "quarantine",
    "read_report",
    "report",
    "run_report",
    "tenant_query",
    "tenant_query_each",
    "write_counted",
    "write_report",
    "write_tenant_query_each",
]
