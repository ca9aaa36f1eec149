"""Run one report, or one SQL text on every tenant, and write the result as CSV.

    spark-submit crosstally/__main__.py report str_return_quantity_diff \\
        --tables /data/tables --out /reports/quantity --since 2025-08-30
    spark-submit crosstally/__main__.py query query.sql --tables /data/tables --out /reports/query

A query whose rows of some tenant can't be processed is written without them; the command names the
tenants and ends with an error.
"""

from __future__ import annotations

import argparse
import inspect
import sys
from decimal import Decimal
from pathlib import Path

from pyspark.sql import SparkSession

if __package__ in (None, ""):
    sys.path[0] = str(Path(__file__).resolve().parents[1])

from crosstally import (
    REPORTS,
    Catalog,
    in_report_order,
    run_report,
    tenant_query,
    write_counted,
    write_tenant_query_each,
)
from crosstally.operators import routing
from crosstally.session import apply_settings
from crosstally.sources.catalog import quarantine


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="crosstally", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    report = commands.add_parser("report", help="run a report of its name")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--since", help="first day to look at, as 2025-08-30")
    report.add_argument(
        "--excluded-tenants", type=lambda names: names.split(","), help="as th303,th997"
    )
    report.add_argument("--tolerance", type=Decimal, help="of amounts, as 1.0")
    report.add_argument("--blank-rule", choices=["or", "literal"], help="what a blank note is")

    query = commands.add_parser("query", help="run SQL whose tables stand in {braces}")
    query.add_argument("file", help="file that holds the SQL")
    query.add_argument(
        "--at-once", action="store_true", help="run it once on all rows, not on each tenant alone"
    )

    for command in (report, query):
        command.add_argument("--tables", required=True, help="folder or database of the entities")
        command.add_argument("--format", choices=["parquet", "csv", "tables"], default="parquet")
        command.add_argument("--out", required=True, help="folder to write the CSV files to")
        command.add_argument("--append", action="store_true", help="add to what is there")
        command.add_argument("--run", help="name of what is appended; repeated, it adds nothing")
        command.add_argument("--quarantine", help="folder for malformed rows of CSV tables, which then are no error")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = apply_settings(SparkSession.builder.appName("crosstally").getOrCreate())
    load = {
        "parquet": Catalog.from_parquet,
        "csv": Catalog.from_csv,
        "tables": Catalog.from_tables,
    }[args.format]
    if args.quarantine:
        if args.format != "csv":
            sys.exit("only CSV tables have malformed rows")
        for entity, count in sorted(quarantine(spark, args.tables, args.quarantine).items()):
            print(f"{entity}: {count} malformed rows", file=sys.stderr)
        tables = Catalog.from_csv(spark, args.tables, malformed="apart")
    else:
        tables = load(spark, args.tables)
    mode = "append" if args.append or args.run else "overwrite"

    if args.command == "report":
        named = ("since", "excluded_tenants", "tolerance", "blank_rule")
        given = {name: getattr(args, name) for name in named if getattr(args, name) is not None}
        known = inspect.signature(REPORTS[args.name]).parameters
        if unknown := [name for name in given if name not in known]:
            sys.exit(f"{args.name} has no parameter {', '.join(unknown)}")
        rows = run_report(args.name, tables, **given)
        names = [row.tenant for row in routing.listed_tenants(tables["tenant_registry"]).collect()]
        counted = names if "tenant" in rows.columns else []
        written = write_counted(in_report_order(args.name, rows), args.out, mode, run=args.run, counted=counted)
        print(f"{written.rows} rows written to {written.path}")
        for name, count in written.counts.items():
            if count:
                print(f"{name}: {count}")
        return

    text = Path(args.file).read_text()
    if args.at_once:
        written = write_counted(tenant_query(spark, text, tables), args.out, mode, run=args.run)
        print(f"{written.rows} rows written to {written.path}")
        return
    if args.run:
        sys.exit("a query on each tenant is written in several steps, which have no run in common")
    failures = write_tenant_query_each(spark, text, tables, args.out, mode)
    for tenant, reason in failures.items():
        print(f"{tenant}: {reason}", file=sys.stderr)
    if failures:
        sys.exit(f"{len(failures)} tenants were skipped")


if __name__ == "__main__":
    main()
