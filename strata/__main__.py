"""Job entry point: ``python -m strata run`` ingests the landing zones and
rebuilds (or incrementally updates) the layered tables under ``--root``."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="ingest, then build silver and gold")
    run.add_argument("--customers", required=True, help="landing directory of customer JSON files")
    run.add_argument("--products", required=True, help="landing directory of product CSV files")
    run.add_argument("--orders", help="landing directory of order Parquet files")
    run.add_argument("--root", required=True, help="warehouse root (shared storage)")
    run.add_argument("--as-of", required=True, help="date stamped on gold tables (yyyy-MM-dd)")
    run.add_argument("--incremental", action="store_true", help="process pending batches only")
    run.add_argument("--master", help="Spark master (default: taken from the environment)")
    args = ap.parse_args(argv)

    from strata.plans.flow import Landing, run_incremental, run_layers
    from strata.session import get_spark
    from strata.streaming.bronze import SourceSpec

    spark = get_spark(args.master)
    landing = Landing(SourceSpec("customers", "json", args.customers),
                      SourceSpec("products", "csv", args.products, {"header": "true", "delimiter": ","}),
                      SourceSpec("orders", "parquet", args.orders) if args.orders else None)
    if args.incremental:
        tables = run_incremental(spark, landing, args.root, args.as_of)
        print(json.dumps(sorted(tables)))
    else:
        counts: dict[str, int] = {}
        run_layers(spark, landing, args.root, args.as_of, counts=counts)
        print(json.dumps(counts, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
