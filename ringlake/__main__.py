"""Batch job: rebuild silver and gold from the landed bronze tree and print the quality report."""

from __future__ import annotations

import argparse

from ringlake.plans.refresh import Names, refresh
from ringlake.plans.silver import BurstRule
from ringlake.schemas import BURST_SECONDS, BURST_THRESHOLD
from ringlake.session import build_session
from ringlake.sources import bronze
from ringlake.sources.jdbc import JdbcTarget


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ringlake", description=__doc__)
    parser.add_argument("--bronze", required=True, help="root of the landed Parquet tree")
    parser.add_argument("--warehouse", required=True, help="folder for silver and gold tables")
    parser.add_argument("--date-filter", help="replace this part of the tree only, for example year=2024/month=01")
    parser.add_argument("--merge-schema", action="store_true", help="union the schemas of the files")
    parser.add_argument("--catalog", help="catalog of all tables")
    parser.add_argument("--silver-database", default="silver")
    parser.add_argument("--gold-database", default="gold")
    parser.add_argument("--burst", action="store_true", help="also flag registration bursts")
    parser.add_argument("--burst-threshold", type=int, default=BURST_THRESHOLD)
    parser.add_argument("--burst-seconds", type=int, default=BURST_SECONDS)
    parser.add_argument("--latest-package", action="store_true")
    parser.add_argument("--per-day", action="store_true", help="rolling labels per package and day")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-table", default="public.subscriptions")
    parser.add_argument("--jdbc-models", action="store_true", help="send the models to the database as well")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    return parser.parse_args(words)


def main(words: list[str] | None = None) -> None:
    args = arguments(words)
    spark = build_session()
    mirror = None
    if args.jdbc_url:
        properties = dict(item.split("=", 1) for item in args.jdbc_property)
        mirror = JdbcTarget(args.jdbc_url, args.jdbc_table, properties)
    done = refresh(
        bronze.scan(spark, args.bronze, args.date_filter, args.merge_schema),
        args.warehouse,
        burst=BurstRule(args.burst_threshold, args.burst_seconds) if args.burst else None,
        names=Names.within(args.silver_database, args.gold_database, args.catalog),
        part=args.date_filter,
        mirror=mirror,
        mirror_models=args.jdbc_models,
        latest_package=args.latest_package,
        per_day=args.per_day,
    )
    if done.report is None:
        print("no bronze rows; nothing written")
        return
    print(f"rows: {done.rows}")
    done.report.show(100, truncate=False)


if __name__ == "__main__":
    main()
