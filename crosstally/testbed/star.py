"""Orders become purchase issues and the invoices that answer them; line items become their items.

The bindings, with the counts they lead to, are in ``FIXTURES.md``; ``oracle.py`` states the same in
SQL. Remainders of the order key decide which defect a document has: every order is used, and each
remainder stands for one case (no note, an empty note, an invoice that was never made, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crosstally.sources.catalog import Catalog

#: Distances between the ids of an issue's documents, so that they stay apart at any scale.
COPY = 10**14
DANGLING = 10**15
SOURCE = 2 * 10**15

TENANTS = 25


def tenant_name(number: Column) -> Column:
    prefix = F.when(number % 2 == 0, "th").otherwise("ar")
    return F.concat(prefix, F.lpad(number.cast("string"), 3, "0"))


def star_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The entities, derived lazily from the Parquet tables in ``sf_dir``."""
    star = _Star(spark, sf_dir)
    return Catalog(lambda entity: getattr(star, entity)())


class _Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def tenant_registry(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.read("nation").select(
            tenant_name(key).alias("tenant"),
            key.cast("bigint").alias("id"),
            F.when(key % 2 == 0, "warehouse").otherwise("arsenal").alias("kind"),
            F.when(key % 12 == 11, 0).otherwise(1).alias("is_setup"),
        )

    def partner_map(self) -> DataFrame:
        return (
            self.read("customer")
            .where(F.col("c_mktsegment") != "HOUSEHOLD")
            .select(
                F.col("c_custkey").cast("string").alias("partner_detail_id"),
                tenant_name(F.col("c_nationkey")).alias("dest_tenant"),
            )
        )

    def purchase_issue(self) -> DataFrame:
        key = F.col("o_orderkey")
        text = key.cast("string")
        state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        own = tenant_name(key % TENANTS)
        return self.read("orders").select(
            own.alias("tenant"),
            key.alias("id"),
            F.col("o_custkey").cast("string").alias("partner_detail_id"),
            F.when(key % 5 == 1, key + DANGLING)
            .when(key % 5 != 0, key + SOURCE)
            .alias("invoice_id"),
            F.concat(F.lit("SI"), text).alias("invoice_no"),
            F.when(priority == "5-LOW", "REGULAR_EASYSOL")
            .when(priority == "1-URGENT", "PR_SALES")
            .when(priority != "4-NOT SPECIFIED", "ICS_RETURN")
            .alias("pr_type"),
            F.col("o_orderdate").alias("invoice_date"),
            F.when(key % 6 == 1, tenant_name((key + 1) % TENANTS))
            .when(key % 6 != 0, own)
            .alias("invoice_tenant"),
            F.when((state == "P") & (key % 4 == 0), "CANCELLED")
            .when(state == "P", "cancelled")
            .when(state == "O", "CREATED")
            .when(state == "F", "DISPATCHED")
            .alias("status"),
            F.when(key % 8 == 1, "")
            .when(key % 8 == 2, F.concat(F.lit("PE"), text))
            .when(key % 8 != 0, F.concat(F.lit("DC"), text))
            .alias("debit_note_number"),
            F.col("o_orderdate").alias("created_on"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("_order_total"),
        )

    def purchase_issue_item(self) -> DataFrame:
        """A line's tenant follows from its order key, so no join with the orders is needed."""
        part = F.col("l_partkey").cast("string")
        return self.read("lineitem").select(
            tenant_name(F.col("l_orderkey") % TENANTS).alias("tenant"),
            F.col("l_orderkey").alias("purchase_issue_id"),
            F.when(F.col("l_partkey") % 10 == 0, part)
            .otherwise(F.lpad(part, 6, "0"))
            .alias("ucode"),
            _batch().alias("batch"),
            F.col("l_quantity").cast("bigint").alias("return_quantity"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        )

    def _answered(self) -> DataFrame:
        """Issues the destination has made an invoice for."""
        return (
            self.purchase_issue()
            .where(F.col("debit_note_number").isNotNull() & (F.col("id") % 10 != 3))
            .join(self.partner_map(), "partner_detail_id")
        )

    def inward_invoice(self) -> DataFrame:
        issue = F.col("id")
        copies = F.array_compact(
            F.array(F.lit(0), F.when(issue % 11 == 0, 1), F.when(issue % 13 == 0, 2))
        )
        k = F.col("k")
        at_destination = (
            self._answered()
            .withColumn("k", F.explode(copies))
            .select(
                F.when(k == 2, F.col("tenant")).otherwise(F.col("dest_tenant")).alias("tenant"),
                (issue + k.cast("bigint") * COPY).alias("id"),
                F.col("debit_note_number").alias("invoice_no"),
                F.when(issue % 9 == 0, "CANCELLED")
                .when(issue % 9 == 1, "draft")
                .otherwise("live")
                .alias("status"),
                _by_remainder(issue, "ICSReturn", "StockTransferReturn", "StockTransfer"),
                "partner_detail_id",
                F.concat(F.lit("user"), (issue % 3 + k).cast("string")).alias("created_by"),
                "created_on",
                (F.col("_order_total") + k).cast("decimal(18,2)").alias("total"),
            )
        )
        partner = F.col("partner_detail_id")
        at_source = self.purchase_issue().select(
            "tenant",
            (issue + SOURCE).alias("id"),
            "invoice_no",
            F.lit("live").alias("status"),
            _by_remainder(issue, "ICS", "StockTransfer", "REGULAR"),
            F.when(issue % 3 == 0, (partner.cast("bigint") + 1).cast("string"))
            .otherwise(partner)
            .alias("partner_detail_id"),
            F.lit("user0").alias("created_by"),
            "created_on",
            F.col("_order_total").alias("total"),
        )
        return at_destination.unionByName(at_source)

    def _answered_lines(self) -> DataFrame:
        """Lines of the first invoice made for each answered issue."""
        answered = self._answered().select(
            F.col("id").alias("l_orderkey"), F.col("dest_tenant").alias("tenant"), "partner_detail_id"
        )
        return self.read("lineitem").join(answered, "l_orderkey")

    def inward_invoice_item(self) -> DataFrame:
        number = F.col("l_linenumber")
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        extra = F.when(number == 6, F.lit(5)).when(number == 5, F.lit(1)).otherwise(F.lit(0))
        return self._answered_lines().select(
            "tenant",
            F.col("l_orderkey").alias("invoice_id"),
            F.lpad(F.col("l_partkey").cast("string"), 6, "0").alias("code"),
            _batch().alias("batch"),
            (F.col("l_quantity").cast("bigint") + F.when(number == 7, 1).otherwise(0)).alias(
                "quantity"
            ),
            (price + extra).cast("decimal(18,2)").alias("net_amount"),
        )

    def debitnote(self) -> DataFrame:
        key, number = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
        credit = F.concat(F.lit("CN"), key, F.lit("-"), number.cast("string"))
        return (
            self._answered_lines()
            .where(F.col("l_returnflag") == "R")
            .select(
                "tenant",
                F.col("l_orderkey").alias("return_order_id"),
                F.when(number == 1, "OTHER")
                .when(F.col("l_linestatus") == "F", "ICS_RETURN")
                .when(F.col("l_linestatus") == "O", "ST_RETURN")
                .alias("note_type"),
                "partner_detail_id",
                F.concat(F.lit("DN"), key, F.lit("-"), (number % 3).cast("string")).alias(
                    "debit_note_number"
                ),
                F.when(number != 4, credit).alias("credit_note_number"),
            )
        )

    def pre_purchase_issue_order(self) -> DataFrame:
        kind = F.col("event_type")
        return self.read("events").select(
            tenant_name(F.col("user_id") % TENANTS).alias("tenant"),
            F.col("event_id").alias("id"),
            F.when(kind == "view", "PRIMARY")
            .when(kind == "click", "SECONDARY")
            .when(kind != "error", "REGULAR")
            .alias("vendor_type"),
            F.col("user_id").cast("string").alias("partner_detail_id"),
            F.when(F.col("event_id") % 3 == 0, "CANCELLED").otherwise("CREATED").alias("status"),
            F.col("ts").alias("created_on"),
        )


def _batch() -> Column:
    return F.concat(F.lit("B"), (F.col("l_suppkey") % 10).cast("string"))


def _by_remainder(issue: Column, first: str, second: str, third: str) -> Column:
    return (
        F.when(issue % 4 == 0, first)
        .when(issue % 4 == 1, second)
        .when(issue % 4 == 2, third)
        .alias("purchase_type")
    )
