"""Entities that grow by runs, with what destinations received kept as sums beside them.

A run is a folder with the new rows of each entity and what they add to the sums. It is written under
another name first and becomes part of the ledger by one rename, so a run that fails leaves nothing and one
that is repeated adds nothing.

The sums are what the reports ask of the destinations, whose items are the bulk of all tables:

* ``received_codes``: by tenant and item code, on how many items of live invoices that are no returns;
* ``received_notes``: by tenant and invoice number, how many invoices aren't cancelled;
* ``received_totals``: by tenant, item code, batch and invoice number, the quantity, the amount and the
  number of the items of invoices that aren't cancelled.

A run holds only what it changes. Its new items are joined with their invoices; of an invoice whose status
it changes, the sums under the old status are taken off and those under the new one added. So nothing is
computed again from the history, and all that is read of it are items of invoices whose status changes.
:func:`crosstally.operators.received.merged` adds the runs up; a key whose count has come down to 0 is gone.

Runs are committed one at a time, in the order in which they happened. Items come with their invoice or
after it, and an invoice comes once. To bring many runs into one, commit the catalog of this ledger as the
first run of another.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from crosstally import values
from crosstally.functions.predicates import invoice_not_cancelled, is_live
from crosstally.operators.grouping import members_of
from crosstally.operators.presence import present_in, shuffled_on
from crosstally.sources.catalog import Catalog, to_save, write_by_tenant
from crosstally.sources.folders import listed, move, remove
from crosstally.sources.schemas import ENTITIES, SCHEMAS, SUMMARIES, conform, ddl

#: New statuses of invoices that earlier runs brought.
STATUSES = "invoice_status"
_STATUS_DDL = "tenant string, id bigint, status string, run_number bigint"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_INVOICE = ("tenant", "id", "invoice_no", "status", "purchase_type")


class Ledger:
    """The entities and sums of all runs committed under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def runs(self) -> list[str]:
        """The names of the committed runs."""
        return sorted(name[4:] for name in listed(self.spark, self.root) if name.startswith("run="))

    def commit(self, run: str, rows: Mapping[str, DataFrame], statuses: DataFrame | None = None) -> bool:
        """Add ``rows`` by entity, and new ``statuses`` (tenant, id, status) of invoices, as one run.

        Gives False, and adds nothing, if a run of this name was committed. A name has letters, digits,
        dots, dashes and underscores. Statuses of invoices that no earlier run brought are left out; of
        several for one invoice the last in text order counts.
        """
        if not _NAME.fullmatch(run):
            raise ValueError(f"{run!r} is no name of a run")
        unknown = set(rows) - set(ENTITIES)
        if unknown:
            raise KeyError(", ".join(sorted(unknown)))
        runs = self.runs()
        if run in runs:
            return False
        staged = f"{self.root}/_staged-{run}"
        remove(self.spark, staged)  # what a run of this name that failed has left
        new = {entity: _exactly(rows[entity], entity) for entity in rows}
        for entity in new:
            write_by_tenant(self._to_save(new, entity), entity, f"{staged}/{_folder(entity)}")
        changed = None
        if statuses is not None:
            known = present_in(
                statuses.select("tenant", "id", "status"), self._entity("inward_invoice"), {"tenant": "tenant", "id": "id"}
            )
            latest = known.groupBy("tenant", "id").agg(F.max("status").alias("status"))
            numbered = latest.withColumn("run_number", F.lit(len(runs)).cast("bigint"))
            write_by_tenant(numbered, STATUSES, f"{staged}/{_folder(STATUSES)}")
            changed = self._read(STATUSES, f"{staged}/{_folder(STATUSES)}")
        # What follows reads the rows as they were written, whatever ``rows`` would give a second time.
        written = {entity: conform(self._read(entity, f"{staged}/{_folder(entity)}"), entity) for entity in new}
        self._write_sums(staged, written, changed)
        move(self.spark, staged, f"{self.root}/run={run}")
        return True

    def catalog(self) -> Catalog:
        """The entities and the sums of all runs; the sums as the runs changed them."""
        return Catalog(self._entity, (*ENTITIES, *SUMMARIES))

    def _read(self, name: str, path: str, reader: DataFrameReader | None = None) -> DataFrame:
        kind = _STATUS_DDL if name == STATUSES else ddl(name)
        if name == "purchase_issue_item":
            kind += f", `{values.CREATED_MONTH}` date, `{values.INVOICE_MONTH}` date"
        if reader is not None:
            kind += ", run string, entity string"
        return (reader or self.spark.read).schema(kind).parquet(path)

    def _read_runs(self, name: str) -> DataFrame:
        """What all runs hold under a name. The run and the name are partitions of its files."""
        folder = _folder(name)
        if not any(folder in listed(self.spark, f"{self.root}/run={run}") for run in self.runs()):
            return self.spark.createDataFrame([], _STATUS_DDL if name == STATUSES else ddl(name))
        reader = self.spark.read.option("basePath", self.root)
        return self._read(name, f"{self.root}/run=*/{folder}", reader).drop("run", "entity")

    def _entity(self, name: str) -> DataFrame:
        rows = self._read_runs(name)
        if name != "inward_invoice":
            return rows
        statuses = self._read_runs(STATUSES)
        return _with_statuses(rows, statuses) if statuses.inputFiles() else rows

    def _to_save(self, new: Mapping[str, DataFrame], entity: str) -> DataFrame:
        """New rows; items of issues get the months of their issue, whichever run it came with."""
        if entity != "purchase_issue_item":
            return new[entity]
        issues = self._entity("purchase_issue").select("tenant", "id", "created_on", "invoice_date")
        if "purchase_issue" in new:
            issues = issues.unionByName(new["purchase_issue"].select(*issues.columns))
        return to_save({entity: new[entity], "purchase_issue": issues}, entity)

    def _write_sums(self, staged: str, written: Mapping[str, DataFrame], changed: DataFrame | None) -> None:
        """What a run adds to the sums and takes off them."""
        before = self._entity("inward_invoice").select(*_INVOICE)
        added = [written["inward_invoice"].select(*_INVOICE)] if "inward_invoice" in written else []
        after, turned = before, []
        if changed is not None:
            under_old = present_in(before, changed, {"tenant": "tenant", "id": "id"})
            turned = [
                under_old.withColumn("sign", F.lit(-1)),
                _with_statuses(under_old, changed).withColumn("sign", F.lit(1)),
            ]
            after = _with_statuses(before, changed)
        headers = [*turned, *(rows.withColumn("sign", F.lit(1)) for rows in added)]
        if headers:
            notes = (
                _union(headers)
                .where(invoice_not_cancelled() & F.col("invoice_no").isNotNull())
                .groupBy("tenant", "invoice_no")
                .agg(F.sum("sign").alias("invoices"))
                .where("invoices != 0")
            )
            write_by_tenant(notes, "received_notes", f"{staged}/{_folder('received_notes')}")

        items = []
        if "inward_invoice_item" in written:
            headers_now = _union([after, *added]).withColumn("sign", F.lit(1))
            items.append(_items_of(headers_now, written["inward_invoice_item"]))
        if turned:
            items.append(_items_of(_union(turned), self._entity("inward_invoice_item")))
        if not items:
            return
        sign, bought = F.col("sign"), is_live() & ~F.col("purchase_type").isin(values.RETURN_INVOICES)
        signed = lambda column: F.coalesce(F.sum(F.col(column) * sign), F.lit(0))
        totals = (
            _union(items)
            .where(invoice_not_cancelled())
            .groupBy("tenant", "code", "batch", "invoice_no")
            .agg(
                signed("quantity").cast("decimal(28,3)").alias("quantity"),
                signed("net_amount").cast("decimal(28,2)").alias("net_amount"),
                F.sum(sign).alias("items"),
                F.coalesce(F.sum(F.when(bought, sign)), F.lit(0)).alias("bought_items"),
            )
            .where("quantity != 0 OR net_amount != 0 OR items != 0 OR bought_items != 0")
        )
        path = f"{staged}/{_folder('received_totals')}"
        write_by_tenant(totals, "received_totals", path)
        codes = (
            self._read("received_totals", path)
            .groupBy("tenant", "code")
            .agg(F.sum("bought_items").alias("bought_items"))
            .where("bought_items != 0 AND code IS NOT NULL")
        )
        write_by_tenant(codes, "received_codes", f"{staged}/{_folder('received_codes')}")


def _exactly(rows: DataFrame, entity: str) -> DataFrame:
    """The columns of the entity and no others, of its types: all runs have the same files."""
    kinds = SCHEMAS[entity]
    return conform(rows, entity).select(*(F.col(c).cast(kind).alias(c) for c, kind in kinds.items()))


def _folder(name: str) -> str:
    return f"entity={name}"


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


def _with_statuses(invoices: DataFrame, statuses: DataFrame) -> DataFrame:
    """``invoices`` with the latest of their ``statuses``; a status may be NULL."""
    latest = statuses.groupBy("tenant", "id").agg(
        F.max_by(F.struct(F.col("status").alias("new")), "run_number").alias("_latest")
    )
    status = F.when(F.col("_latest").isNotNull(), F.col("_latest.new")).otherwise(F.col("status"))
    return members_of(invoices, latest, ["tenant", "id"], "left").withColumn("status", status).drop("_latest")


def _items_of(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Items with their invoice. One with very many items can be split; only its tenants' items are read."""
    own = items.where(F.col("invoice_id").isNotNull()).select(
        F.col("tenant").alias("_tenant"), F.col("invoice_id").alias("_id"), "code", "batch", "quantity", "net_amount"
    )
    same = (F.col("tenant") == F.col("_tenant")) & shuffled_on(["id"])
    return headers.join(own, same).drop("_tenant", "_id", "id")
