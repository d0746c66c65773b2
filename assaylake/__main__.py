"""Run one step of the load chain.

    python -m assaylake all --raw s3a://in/raw --base s3a://lake --buckets 20000
    spark-submit --py-files assaylake.zip submit.py all --raw ... --base ...
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from assaylake import specs
from assaylake.plans import jobs
from assaylake.plans.marts import MARTS
from assaylake.plans.store import TableStore
from assaylake.session import tuned
from assaylake.sources.generators import write_raw_fixture

STEPS = ("fixture", "bronze", "silver", "gold", "all", "verify")


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="assaylake", description=__doc__.splitlines()[0])
    p.add_argument("step", choices=STEPS)
    p.add_argument("--base", required=True, help="folder of the bronze files and tables")
    p.add_argument("--raw", help="folder of the raw files")
    p.add_argument("--years", type=int, nargs="+", default=list(specs.DEFAULT_YEARS))
    p.add_argument("--load-ts", help="load time in UTC; now, if left out")
    p.add_argument("--cap", type=int, help="rows per extract; none, if left out")
    p.add_argument("--refresh-users-year", type=int, help="replace the users of this year")
    p.add_argument("--refresh", nargs="+", default=[], choices=["posts", "users", "votes", "badges"],
                   help="entities to copy again")
    p.add_argument("--buckets", type=int, help="files per table; one per shuffle partition, if left out")
    p.add_argument("--marts", nargs="+", choices=list(MARTS), default=list(MARTS))
    args = p.parse_args(argv)
    if args.step in ("fixture", "bronze", "all") and not args.raw:
        p.error(f"{args.step} needs --raw")
    args.load_ts = args.load_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    tuned(spark)
    base = args.base.rstrip("/")
    bronze = f"{base}/bronze"
    if args.step == "fixture":
        write_raw_fixture(spark, args.raw, args.years)
    if args.step in ("bronze", "all"):
        for path in jobs.run_bronze(
            spark, args.raw, bronze, args.years, args.cap, args.refresh_users_year, args.refresh
        ):
            print(path)
    if args.step in ("fixture", "bronze"):
        return
    store = TableStore(spark, f"{base}/tables", args.buckets)
    counts = {}
    if args.step in ("silver", "all"):
        counts.update(jobs.run_silver(spark, bronze, store, args.load_ts, args.years))
    if args.step in ("gold", "all"):
        counts.update(jobs.run_gold(store, args.load_ts, args.marts))
    for name, rows in counts.items():
        print(f"{name} {rows}")
    if args.step == "verify":
        files, size = jobs.write_listing(spark, bronze, f"{base}/_listing")
        jobs.verify_bronze(spark, bronze).show(20, truncate=False)
        print(f"{files} files, {size} bytes; all are listed in {base}/_listing")
        for mart in args.marts:
            count, sample = jobs.verify_gold(store, mart)
            count.show(truncate=False)
            sample.show(truncate=False)


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parse(sys.argv[1:])
    session = SparkSession.builder.appName(f"assaylake {args.step}").getOrCreate()
    run(session, args)
    session.stop()


if __name__ == "__main__":
    main()
