"""Command line: ``python -m landledger silver ...`` and ``... gold ...``."""

from __future__ import annotations

import argparse
import sys

from landledger.operators.quality import QualityGateError
from landledger.plans.gold import run_gold
from landledger.plans.silver import RawLayout, run_silver
from landledger.session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="landledger")
    commands = top.add_subparsers(dest="command", required=True)

    silver = commands.add_parser("silver", help="raw files to the checked sales table")
    silver.add_argument("--root", required=True, help="folder with one directory per raw dataset")
    silver.add_argument("--target", required=True, help="sales table to publish to")
    silver.add_argument("--year", type=int, nargs="+", required=True)
    silver.add_argument("--dept", nargs="+", required=True)
    silver.add_argument("--publication", required=True)
    silver.add_argument("--dpe-extraction-date", required=True)
    silver.add_argument("--geo-extraction-date", required=True)
    silver.add_argument("--hot-share", type=float, help="salt addresses with at least this share of the sales")
    silver.add_argument("--one-per-address", action="store_true", help="keep the best result of addresses that coincide once typed")
    silver.add_argument("--null-safe-address", action="store_true", help="let missing house numbers match each other")
    silver.add_argument("--one-switch", action="store_true", help="publish all partitions at once, as a table of versions")
    silver.add_argument("--nan-to-null", action="store_true", help="take NaN in numbers as missing")

    gold = commands.add_parser("gold", help="sales table to price statistics")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--commune-target", required=True)
    gold.add_argument("--department-target", required=True)
    for command in (silver, gold):
        command.add_argument(
            "--shuffle-gb", type=float, help="gigabytes that the largest shuffle moves; sets the number of its partitions"
        )
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    width = None if args.shuffle_gb is None else int(args.shuffle_gb * 1e9)
    spark = session(f"landledger-{args.command}", shuffle_bytes=width)
    if args.command == "gold":
        run_gold(spark, args.silver, args.commune_target, args.department_target)
        return 0
    layout = RawLayout(args.root, args.publication, args.dpe_extraction_date, args.geo_extraction_date)
    try:
        run_silver(
            spark, layout, args.target, args.year, args.dept,
            args.one_per_address, args.null_safe_address, args.hot_share, nan_to_null=args.nan_to_null, one_switch=args.one_switch,
        )
    except QualityGateError as error:
        print(f"nothing published: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
