"""Command line for the batch jobs (run with spark-submit or python -m tidemark).

  refresh  PLANS CUSTOMERS EVENTS BASE [--expected-plans N] [--validate] [--partitions N]
  validate BASE   (exit code 1 when a check fails)
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidemark.plans import jobs


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("plans")
    r.add_argument("customers")
    r.add_argument("events")
    r.add_argument("base")
    r.add_argument("--expected-plans", type=int, default=None)
    r.add_argument("--validate", action="store_true", help="list the version only if all validators pass")
    r.add_argument("--partitions", type=int, default=None, help="tasks of the stages that build and write the ledger")
    v = sub.add_parser("validate")
    v.add_argument("base")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
    if args.command == "refresh":
        print(jobs.refresh(spark, args.plans, args.customers, args.events, args.base, args.expected_plans,
                           validate=args.validate, partitions=args.partitions))
        return 0
    result = jobs.validate(spark, args.base)
    result.show(truncate=False)
    ok = result.where("check_name = 'all_checks'").first()
    return 0 if ok is not None and ok["passed"] else 1


if __name__ == "__main__":
    sys.exit(main())
