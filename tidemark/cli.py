"""Command line: ``python -m tidemark version | queries | run NAME --data DIR``."""

from __future__ import annotations

import argparse
import sys

from tidemark import __version__, logs
from tidemark.settings import Settings


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description="Fundamental value and market analytics on Spark.")
    sub = parser.add_subparsers(dest="command")
    sub.add_parser("version", help="print the version")
    sub.add_parser("queries", help="list the registered queries")
    sub.add_parser("companies", help="list the configured companies")
    run = sub.add_parser("run", help="run a query and write or show its result")
    run.add_argument("name")
    run.add_argument("--data", required=True, help="folder or URI that holds the tables")
    run.add_argument("--out", help="Parquet folder; without it the first rows are shown")
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = build_parser()
    args = parser.parse_args(argv)
    settings = Settings.load()
    logs.attach(settings.log)
    if args.command is None:
        parser.print_help()
        return 2
    if args.command == "version":
        print(__version__)
        return 0
    if args.command == "companies":
        from tidemark.sources.registry import read_companies

        for key, company in read_companies().items():
            print(f"{key}\t{company.ticker}\t{company.name_en}\t{'on' if company.enabled else 'off'}")
        return 0
    from tidemark.plans import QUERIES

    if args.command == "queries":
        print("\n".join(sorted(QUERIES)))
        return 0
    if args.name not in QUERIES:
        print(f"unknown query {args.name!r}", file=sys.stderr)
        return 1
    from tidemark.session import build_session

    spark = build_session()
    logs.quiet_spark(spark, settings.log)
    logs.LOGGER.info("query starts", extra={"fields": {"query": args.name, "data": args.data}})
    frame = QUERIES[args.name](spark, args.data)
    if args.out:
        frame.write.mode("overwrite").parquet(args.out)
    else:
        frame.show(truncate=False)
    return 0
