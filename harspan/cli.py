"""Command line: analyse archives, refine a capped search over a table, or both."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from .operators.dedup import deduplicate
from .operators.openapi import openapi_document
from .operators.registry import clean_fields, export_rows
from .operators.search import kept_search, leaf_search
from .plans.analyze import analyze_archive, write_report, write_tables
from .session import local_session
from .sinks.xlsx import write_workbook


def _analyze(args: argparse.Namespace) -> None:
    found = analyze_archive(local_session(), args.har, redact=not args.show_secrets)
    if args.output.endswith(".xlsx"):
        print(json.dumps(write_report(found, args.output)))
    else:
        print("\n".join(write_tables(found, args.output)))
    if args.openapi:
        with open(args.openapi, "w", encoding="utf-8") as file:
            json.dump(openapi_document(found.calls), file, indent=2)


def _search(args: argparse.Namespace) -> None:
    rows = local_session().read.parquet(args.table)
    found = leaf_search(rows, args.field, args.cap) if args.discard_capped else kept_search(rows, args.field, [F.col(args.order)], args.cap)
    export = export_rows(deduplicate(clean_fields(found), args.key, [F.col(args.order)]))
    print(json.dumps(write_workbook(args.output, [("Registry", export)])))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="harspan", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("analyze", "full"):
        one = commands.add_parser(name)
        one.add_argument("har")
        one.add_argument("--output", default="report.xlsx")
        one.add_argument("--show-secrets", action="store_true")
        one.add_argument("--openapi")
    for name in ("search", "full"):
        one = commands.choices["full"] if name == "full" else commands.add_parser(name)
        one.add_argument("--table", required=True)
        one.add_argument("--field", default="customerName")
        one.add_argument("--order", default="rec_id")
        one.add_argument("--key", default="licNo")
        one.add_argument("--cap", type=int, default=100)
        one.add_argument("--discard-capped", action="store_true")
        if name == "search":
            one.add_argument("--output", default="registry.xlsx")
    args = parser.parse_args(argv)
    if args.command in ("analyze", "full"):
        _analyze(args)
    if args.command in ("search", "full"):
        if args.command == "full":
            args.output = "registry.xlsx"
        _search(args)


if __name__ == "__main__":
    main()
