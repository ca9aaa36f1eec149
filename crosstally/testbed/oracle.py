"""The reports in SQL for DuckDB, on the entities that ``star.py`` derives."""

from __future__ import annotations


def _tenant(number: str) -> str:
    return (
        f"(CASE WHEN ({number}) % 2 = 0 THEN 'th' ELSE 'ar' END"
        f" || lpad(CAST(({number}) AS VARCHAR), 3, '0'))"
    )


ENTITIES = f"""
WITH tenant_registry AS (
  SELECT {_tenant('n_nationkey')} AS tenant, CAST(n_nationkey AS BIGINT) AS id,
         CASE WHEN n_nationkey % 2 = 0 THEN 'warehouse' ELSE 'arsenal' END AS kind,
         CASE WHEN n_nationkey % 12 = 11 THEN 0 ELSE 1 END AS is_setup
  FROM nation
), active AS (
  SELECT tenant, kind FROM tenant_registry WHERE is_setup = 1
), partner_map AS (
  SELECT CAST(c_custkey AS VARCHAR) AS partner_detail_id, {_tenant('c_nationkey')} AS dest_tenant
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
), purchase_issue AS (
  SELECT o_orderkey AS id, {_tenant('o_orderkey % 25')} AS tenant,
         CAST(o_custkey AS VARCHAR) AS partner_detail_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'CANCELLED'
              WHEN o_orderstatus = 'P' THEN 'cancelled'
              WHEN o_orderstatus = 'O' THEN 'CREATED'
              WHEN o_orderstatus = 'F' THEN 'DISPATCHED' END AS status,
         CASE o_orderpriority WHEN '5-LOW' THEN 'REGULAR_EASYSOL' WHEN '1-URGENT' THEN 'PR_SALES'
              WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'ICS_RETURN' END AS pr_type,
         CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'PE' || o_orderkey
              ELSE 'DC' || o_orderkey END AS debit_note_number,
         CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN o_orderkey + 1000000000000000
              ELSE o_orderkey + 2000000000000000 END AS invoice_id,
         'SI' || o_orderkey AS invoice_no,
         CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN {_tenant('(o_orderkey + 1) % 25')}
              ELSE {_tenant('o_orderkey % 25')} END AS invoice_tenant,
         o_orderdate AS invoice_date, o_orderdate AS created_on,
         CAST(o_totalprice AS DECIMAL(18,2)) AS order_total
  FROM orders
), purchase_issue_item AS (
  SELECT pi.tenant, l_orderkey AS purchase_issue_id,
         CASE WHEN l_partkey % 10 = 0 THEN CAST(l_partkey AS VARCHAR)
              ELSE lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS ucode,
         'B' || (l_suppkey % 10) AS batch, CAST(l_quantity AS BIGINT) AS return_quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN purchase_issue pi ON pi.id = l_orderkey
), answered AS (
  SELECT pi.*, pm.dest_tenant
  FROM purchase_issue pi JOIN partner_map pm USING (partner_detail_id)
  WHERE pi.debit_note_number IS NOT NULL AND pi.id % 10 <> 3
), copies AS (
  SELECT *, 0 AS k FROM answered
  UNION ALL SELECT *, 1 AS k FROM answered WHERE id % 11 = 0
  UNION ALL SELECT *, 2 AS k FROM answered WHERE id % 13 = 0
), inward_invoice AS (
  SELECT CASE WHEN k = 2 THEN tenant ELSE dest_tenant END AS tenant,
         id + k * 100000000000000 AS id, debit_note_number AS invoice_no,
         CASE id % 9 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'draft' ELSE 'live' END AS status,
         CASE id % 4 WHEN 0 THEN 'ICSReturn' WHEN 1 THEN 'StockTransferReturn'
              WHEN 2 THEN 'StockTransfer' END AS purchase_type,
         partner_detail_id, 'user' || (id % 3 + k) AS created_by, created_on,
         CAST(order_total + k AS DECIMAL(18,2)) AS total
  FROM copies
  UNION ALL
  SELECT tenant, id + 2000000000000000, invoice_no, 'live',
         CASE id % 4 WHEN 0 THEN 'ICS' WHEN 1 THEN 'StockTransfer' WHEN 2 THEN 'REGULAR' END,
         CASE WHEN id % 3 = 0 THEN CAST(CAST(partner_detail_id AS BIGINT) + 1 AS VARCHAR)
              ELSE partner_detail_id END,
         'user0', created_on, order_total
  FROM purchase_issue
), answered_lines AS (
  SELECT l.*, a.dest_tenant, a.partner_detail_id
  FROM lineitem l JOIN answered a ON a.id = l.l_orderkey
), inward_invoice_item AS (
  SELECT dest_tenant AS tenant, l_orderkey AS invoice_id,
         lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code, 'B' || (l_suppkey % 10) AS batch,
         CAST(l_quantity AS BIGINT) + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CASE l_linenumber
              WHEN 6 THEN 5 WHEN 5 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS net_amount
  FROM answered_lines
), debitnote AS (
  SELECT dest_tenant AS tenant, l_orderkey AS return_order_id,
         CASE WHEN l_linenumber = 1 THEN 'OTHER' WHEN l_linestatus = 'F' THEN 'ICS_RETURN'
              WHEN l_linestatus = 'O' THEN 'ST_RETURN' END AS note_type,
         partner_detail_id, 'DN' || l_orderkey || '-' || (l_linenumber % 3) AS debit_note_number,
         CASE WHEN l_linenumber = 4 THEN NULL
              ELSE 'CN' || l_orderkey || '-' || l_linenumber END AS credit_note_number
  FROM answered_lines WHERE l_returnflag = 'R'
), pre_purchase_issue_order AS (
  SELECT {_tenant('user_id % 25')} AS tenant, event_id AS id,
         CASE event_type WHEN 'view' THEN 'PRIMARY' WHEN 'click' THEN 'SECONDARY'
              WHEN 'error' THEN NULL ELSE 'REGULAR' END AS vendor_type,
         CAST(user_id AS VARCHAR) AS partner_detail_id,
         CASE WHEN event_id % 3 = 0 THEN 'CANCELLED' ELSE 'CREATED' END AS status,
         ts AS created_on
  FROM events
)"""

ISSUE_KEPT = "lower(pi.status) NOT IN ('cancelled', 'deleted')"
INVOICE_KEPT = "lower(ii.status) NOT IN ('cancelled', 'deleted')"
RETURN_TYPES = "('StockTransferReturn', 'ICSReturn')"


def _ucode_missing(note: str) -> str:
    return f"""{ENTITIES}
SELECT DISTINCT pi.tenant, pi.partner_detail_id, lpad(it.ucode, 6, '0') AS ucode, pm.dest_tenant
FROM purchase_issue pi
JOIN active a ON a.tenant = pi.tenant
JOIN partner_map pm ON pm.partner_detail_id = pi.partner_detail_id
JOIN purchase_issue_item it ON it.tenant = pi.tenant AND it.purchase_issue_id = pi.id
WHERE {ISSUE_KEPT} AND pi.created_on >= DATE '1997-01-01' AND {note}
  AND NOT EXISTS (
    SELECT 1 FROM inward_invoice ii
    JOIN inward_invoice_item ai ON ai.tenant = ii.tenant AND ai.invoice_id = ii.id
    WHERE lower(ii.status) = 'live' AND ii.purchase_type NOT IN {RETURN_TYPES}
      AND ii.tenant = pm.dest_tenant AND ai.code = lpad(it.ucode, 6, '0'))"""


def _compared(sent: str, received: str, as_type: str) -> str:
    return f"""{ENTITIES}, sent AS (
  SELECT pi.tenant, it.ucode, it.batch, pi.debit_note_number, pm.dest_tenant,
         CAST(coalesce(sum({sent}), 0) AS {as_type}) AS sent_total
  FROM purchase_issue pi
  JOIN active a ON a.tenant = pi.tenant
  JOIN partner_map pm ON pm.partner_detail_id = pi.partner_detail_id
  JOIN purchase_issue_item it ON it.tenant = pi.tenant AND it.purchase_issue_id = pi.id
  WHERE pi.pr_type <> 'REGULAR_EASYSOL' AND pi.debit_note_number <> '' AND {ISSUE_KEPT}
    AND pi.created_on >= DATE '1997-01-01'
  GROUP BY pi.tenant, it.ucode, it.batch, pi.debit_note_number, pi.partner_detail_id,
           pm.dest_tenant
), received AS (
  SELECT ii.tenant, ai.code, ai.batch, ii.invoice_no,
         CAST(coalesce(sum({received}), 0) AS {as_type}) AS received_total
  FROM inward_invoice ii
  JOIN inward_invoice_item ai ON ai.tenant = ii.tenant AND ai.invoice_id = ii.id
  WHERE {INVOICE_KEPT}
  GROUP BY ii.tenant, ai.code, ai.batch, ii.invoice_no
), compared AS (
  SELECT s.*, CAST(coalesce(r.received_total, 0) AS {as_type}) AS received_total,
         CAST(coalesce(r.received_total, 0) - s.sent_total AS {as_type}) AS diff,
         r.tenant IS NOT NULL AS is_received
  FROM sent s LEFT JOIN received r
    ON r.tenant = s.dest_tenant AND r.code = s.ucode AND r.batch = s.batch
   AND r.invoice_no = s.debit_note_number
)"""


QUANTITIES = _compared("it.return_quantity", "ai.quantity", "BIGINT")
QUANTITY_COLUMNS = """tenant, ucode, batch, debit_note_number,
       sent_total AS "totalQuantityInPurchaseIssue",
       received_total AS "totalQuantityInInwardInvoice", diff, dest_tenant"""

TENANT_QUERY = f"""{ENTITIES}
SELECT o.* FROM pre_purchase_issue_order o JOIN active a ON a.tenant = o.tenant
WHERE o.created_on >= DATE '2024-01-10' AND lower(o.status) = 'created'
  AND o.vendor_type = 'PRIMARY'"""

QUANTITY_DIFF = f"""{QUANTITIES}
SELECT {QUANTITY_COLUMNS} FROM compared WHERE diff <> 0"""

STATUS = f"""{QUANTITIES}, status AS (
  SELECT {QUANTITY_COLUMNS},
         CASE WHEN diff = 0 THEN 'PASS' ELSE 'FAIL' END AS validation_status,
         CASE WHEN diff = 0 THEN NULL WHEN NOT is_received THEN 'NOT_INWARDED'
              ELSE 'QUANTITY_DIFFERENT' END AS issue
  FROM compared
)"""

RETURN_INVOICES = f"""return_invoice AS (
  SELECT ii.* FROM inward_invoice ii JOIN active a ON a.tenant = ii.tenant
  WHERE ii.purchase_type IN {RETURN_TYPES} AND lower(ii.status) = 'live'
    AND ii.created_on >= DATE '1996-05-28'
)"""

ORACLE: dict[str, str] = {
    "active_tenants": f"{ENTITIES} SELECT tenant, kind FROM active",
    "tenant_lookup": f"""{ENTITIES}, names AS (
  SELECT {_tenant('n_nationkey')} AS tenant FROM nation
)
SELECT n.tenant,
       CASE WHEN n.tenant LIKE 'ar%' THEN 'arsenal' ELSE 'warehouse' END AS kind,
       (SELECT min(r.id) FROM tenant_registry r
        WHERE r.tenant = n.tenant AND r.is_setup = 1
          AND r.kind = CASE WHEN n.tenant LIKE 'ar%' THEN 'arsenal' ELSE 'warehouse' END
       ) AS registry_id
FROM names n""",
    "partner_destination": f"""{ENTITIES}
SELECT pi.tenant, pi.id AS purchase_issue_id, pi.partner_detail_id, pm.dest_tenant
FROM purchase_issue pi JOIN partner_map pm ON pm.partner_detail_id = pi.partner_detail_id""",
    "tenant_query": TENANT_QUERY,
    "tenant_query_each": TENANT_QUERY,
    "tenant_query_aggregate": f"""{ENTITIES}, inwarded AS (
  SELECT ii.tenant, i.code, CAST(sum(i.quantity) AS BIGINT) AS quantity,
         CAST(sum(i.net_amount) AS DECIMAL(18,2)) AS net_amount, count(DISTINCT ii.id) AS invoices
  FROM inward_invoice ii JOIN inward_invoice_item i ON i.tenant = ii.tenant AND i.invoice_id = ii.id
  WHERE ii.status = 'live' AND ii.tenant IN (SELECT tenant FROM active)
  GROUP BY ii.tenant, i.code
)
SELECT * FROM inwarded
QUALIFY row_number() OVER (PARTITION BY tenant ORDER BY quantity DESC, code) <= 5""",
    "ucode_missing_dc_not_generated": _ucode_missing(
        "(pi.debit_note_number IS NULL OR pi.debit_note_number = '')"
    ),
    "ucode_missing_dc_generated": _ucode_missing(
        "pi.debit_note_number IS NOT NULL AND pi.debit_note_number <> ''"
    ),
    "invalid_invoice_in_pr": f"""{ENTITIES}
SELECT pm.dest_tenant, pi.tenant AS source_tenant, pi.id AS purchase_issue_id, pi.invoice_id,
       pi.invoice_no, pi.pr_type, pi.invoice_tenant,
       (pi.invoice_tenant IS NOT DISTINCT FROM pi.tenant) AS is_invoice_tenant_same,
       pi.status, pi.debit_note_number
FROM purchase_issue pi
JOIN active a ON a.tenant = pi.tenant
JOIN partner_map pm ON pm.partner_detail_id = pi.partner_detail_id
LEFT JOIN inward_invoice ii ON ii.tenant = pi.tenant AND ii.id = pi.invoice_id
WHERE pi.pr_type <> 'REGULAR_EASYSOL' AND {ISSUE_KEPT} AND pi.created_on >= DATE '1997-01-01'
  AND pi.invoice_id IS NOT NULL AND pi.tenant NOT IN ('th024', 'ar023')
  AND (ii.id IS NULL
       OR (coalesce(ii.purchase_type IN ('ICS', 'StockTransfer'), FALSE)
           AND ii.partner_detail_id IS DISTINCT FROM pi.partner_detail_id))""",
    "dc_created_str_not_created": f"""{ENTITIES}, noted AS (
  SELECT DISTINCT pi.tenant, pi.partner_detail_id, pi.debit_note_number
  FROM purchase_issue pi
  JOIN active a ON a.tenant = pi.tenant
  JOIN purchase_issue_item it ON it.tenant = pi.tenant AND it.purchase_issue_id = pi.id
  WHERE pi.debit_note_number IS NOT NULL AND pi.invoice_date >= DATE '1997-01-01'
    AND pi.pr_type <> 'REGULAR_EASYSOL' AND {ISSUE_KEPT} AND pi.debit_note_number NOT LIKE 'PE%'
)
SELECT n.debit_note_number AS source_debit_note_number, pm.dest_tenant, n.tenant AS source_tenant
FROM noted n JOIN partner_map pm ON pm.partner_detail_id = n.partner_detail_id
WHERE NOT EXISTS (
  SELECT 1 FROM inward_invoice ii
  WHERE ii.tenant = pm.dest_tenant AND ii.invoice_no = n.debit_note_number AND {INVOICE_KEPT})""",
    "duplicate_str_inward_invoice": f"""{ENTITIES}
SELECT ii.tenant, ii.invoice_no, string_agg(DISTINCT ii.status, ', ' ORDER BY ii.status) AS statuses,
       min(ii.created_on) AS first_created_on, max(ii.created_on) AS last_created_on,
       CAST(sum(ii.total) AS DECIMAL(28,2)) AS total_amount_invoice, count(*) AS total_count
FROM inward_invoice ii JOIN active a ON a.tenant = ii.tenant
WHERE ii.purchase_type IN {RETURN_TYPES} AND {INVOICE_KEPT}
  AND ii.created_on >= DATE '1997-01-01'
GROUP BY ii.tenant, ii.invoice_no HAVING count(*) > 1""",
    "duplicate_str_inward_invoice_members": f"""{ENTITIES}, counted AS (
  SELECT ii.tenant, ii.invoice_no, ii.id, ii.status, ii.created_on, ii.created_by, ii.total,
         count(*) OVER (PARTITION BY ii.tenant, ii.invoice_no) AS total_count
  FROM inward_invoice ii JOIN active a ON a.tenant = ii.tenant
  WHERE ii.purchase_type IN {RETURN_TYPES} AND {INVOICE_KEPT}
    AND ii.created_on >= DATE '1997-01-01'
)
SELECT * FROM counted WHERE total_count > 1""",
    "pr_sales_without_note": f"""{ENTITIES}
SELECT pi.tenant, pi.id AS purchase_issue_id, pi.pr_type, pi.debit_note_number,
       pi.partner_detail_id, pi.created_on, pi.status
FROM purchase_issue pi JOIN active a ON a.tenant = pi.tenant
WHERE pi.pr_type = 'PR_SALES' AND (pi.debit_note_number IS NULL OR pi.debit_note_number = '')
  AND {ISSUE_KEPT} AND pi.created_on >= DATE '1996-07-01'""",
    "non_regular_vendor_type": f"""{ENTITIES}
SELECT o.tenant, o.id AS pre_purchase_issue_order_id, o.vendor_type, o.partner_detail_id,
       o.created_on, o.status
FROM pre_purchase_issue_order o JOIN active a ON a.tenant = o.tenant
WHERE o.vendor_type IN ('PRIMARY', 'SECONDARY') AND lower(o.status) = 'created'
  AND o.created_on >= DATE '2024-01-05'""",
    "str_amount_mismatch": f"""{_compared('it.amount', 'ai.net_amount', 'DECIMAL(28,2)')}
SELECT tenant, ucode, batch, debit_note_number, sent_total AS "totalAmountInPurchaseIssue",
       received_total AS "totalAmountInInwardInvoice", CAST(abs(diff) AS DECIMAL(28,2)) AS diff,
       dest_tenant
FROM compared WHERE abs(diff) > 1.0""",
    "str_return_quantity_diff": QUANTITY_DIFF,
    "multi_cn_for_str_inward": f"""{ENTITIES}, {RETURN_INVOICES}
SELECT d.return_order_id, min(d.note_type) AS note_type,
       min(d.partner_detail_id) AS partner_detail_id,
       count(DISTINCT d.debit_note_number) AS total_debit_note_numbers, d.tenant
FROM debitnote d
WHERE d.note_type IN ('ICS_RETURN', 'ST_RETURN')
  AND EXISTS (SELECT 1 FROM return_invoice ii
              WHERE ii.tenant = d.tenant AND ii.id = d.return_order_id)
GROUP BY d.tenant, d.return_order_id HAVING count(DISTINCT d.debit_note_number) > 1""",
    "multi_cn_for_str_inward_notes": f"""{ENTITIES}, {RETURN_INVOICES}, of_invoice AS (
  SELECT * FROM debitnote d
  WHERE d.note_type IN ('ICS_RETURN', 'ST_RETURN')
    AND EXISTS (SELECT 1 FROM return_invoice ii
                WHERE ii.tenant = d.tenant AND ii.id = d.return_order_id)
), several AS (
  SELECT tenant, return_order_id, count(DISTINCT debit_note_number) AS total_debit_note_numbers
  FROM of_invoice GROUP BY tenant, return_order_id HAVING count(DISTINCT debit_note_number) > 1
)
SELECT s.tenant, s.return_order_id, s.total_debit_note_numbers, d.debit_note_number,
       d.credit_note_number, count(*) AS copies
FROM of_invoice d JOIN several s ON s.tenant = d.tenant AND s.return_order_id = d.return_order_id
GROUP BY ALL""",
    "no_cn_for_str_inward": f"""{ENTITIES}, {RETURN_INVOICES}
SELECT ii.id AS invoice_id, ii.invoice_no, ii.created_on, ii.tenant
FROM return_invoice ii
WHERE NOT EXISTS (
  SELECT 1 FROM debitnote d
  WHERE d.tenant = ii.tenant AND d.return_order_id = ii.id
    AND d.note_type IN ('ICS_RETURN', 'ST_RETURN'))""",
    "received_totals": f"""{ENTITIES}
SELECT ii.tenant, i.code, i.batch, ii.invoice_no,
       CAST(sum(i.quantity) AS BIGINT) AS quantity, CAST(sum(i.net_amount) AS DECIMAL(18,2)) AS net_amount,
       count(*) AS items,
       count(*) FILTER (WHERE ii.status = 'live'
                        AND ii.purchase_type NOT IN ('StockTransferReturn', 'ICSReturn')) AS bought_items
FROM inward_invoice ii JOIN inward_invoice_item i ON i.tenant = ii.tenant AND i.invoice_id = ii.id
WHERE ii.status <> 'CANCELLED' AND NOT (ii.id % 2 = 0 AND ii.id % 7 = 3)
GROUP BY ALL""",
    "csv_report_roundtrip": QUANTITY_DIFF,
    "recon_status": f"{STATUS} SELECT * FROM status",
    "recon_summary_levels": f"""{STATUS}
SELECT CASE WHEN grouping(tenant, dest_tenant, issue) = 7 THEN 'all'
            WHEN grouping(tenant, dest_tenant, issue) = 3 THEN 'tenant'
            WHEN grouping(tenant, dest_tenant, issue) = 1 THEN 'pair'
            WHEN grouping(tenant, dest_tenant, issue) = 6 THEN 'issue'
            ELSE 'tenant_issue' END AS level,
       tenant, dest_tenant, issue, count(*) AS checked,
       count(*) FILTER (WHERE validation_status = 'FAIL') AS failed,
       round(100.0 * count(*) FILTER (WHERE validation_status = 'FAIL') / count(*), 2) AS failed_percent,
       round(100.0 * count(*) / (SELECT count(*) FROM status), 2) AS checked_percent
FROM status
GROUP BY GROUPING SETS ((), (tenant), (tenant, dest_tenant), (issue), (tenant, issue))""",
    "recon_summary": f"""{STATUS}
SELECT tenant, count(*) AS checked,
       count(*) FILTER (WHERE validation_status = 'FAIL') AS failed,
       round(100.0 * count(*) FILTER (WHERE validation_status = 'FAIL') / count(*), 2)
         AS failed_percent
FROM status GROUP BY tenant""",
}
