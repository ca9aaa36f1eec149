"""Fixed values of the domain.

The strings, dates and numbers below are part of the reports' meaning: they must be equal to what
the tables hold, so they are stated here once, as they are.
"""

from datetime import date
from decimal import Decimal

# Statuses. Compared without regard to case.
ISSUE_CANCELLED = ["cancelled", "DELETED"]
INVOICE_CANCELLED = ["CANCELLED", "DELETED"]
LIVE = "live"
CREATED = "CREATED"

# Types of purchase returns, invoices, notes and vendors. Compared exactly.
REGULAR_RETURN = "REGULAR_EASYSOL"
SALES_RETURN = "PR_SALES"
RETURN_INVOICES = ["StockTransferReturn", "ICSReturn"]
TRANSFER_INVOICES = ["ICS", "StockTransfer"]
RETURN_NOTES = ["ICS_RETURN", "ST_RETURN"]
REPORTED_VENDORS = ["PRIMARY", "SECONDARY"]

# Notes with this prefix have no counterpart at the destination.
UNMATCHED_NOTE_PREFIX = "PE"

# Item codes are padded to this width before they are looked up at the destination.
ITEM_CODE_WIDTH = 6

# Amounts may differ by this much.
AMOUNT_TOLERANCE = Decimal("1.0")

# Tenants whose invoice references are not checked.
UNCHECKED_TENANTS = ["th303", "th997", "th438"]

# A tenant whose name starts with this is registered as an arsenal, any other as a warehouse.
ARSENAL_PREFIX = "ar"
ARSENAL = "arsenal"
WAREHOUSE = "warehouse"

# First day each report looks at.
TENANT_QUERY_SINCE = date(2025, 8, 1)
ITEM_CODES_SINCE = date(2025, 8, 26)
INVOICE_REFERENCES_SINCE = date(2025, 8, 26)
NOTES_SINCE = date(2025, 8, 26)
DUPLICATES_SINCE = date(2025, 8, 26)
SALES_RETURNS_SINCE = date(2025, 7, 1)
VENDORS_SINCE = date(2025, 7, 1)
TOTALS_SINCE = date(2025, 8, 30)
RETURN_INVOICES_SINCE = date(2025, 5, 28)

# Between the values of a joined list.
LIST_SEPARATOR = ", "

# Columns of saved item tables: the months of an item's issue, by which old items are skipped.
CREATED_MONTH = "issue_created_month"
INVOICE_MONTH = "issue_invoice_month"
