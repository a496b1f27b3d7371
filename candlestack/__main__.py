"""Run registered queries from the command line.

    python -m candlestack list
    python -m candlestack run period_stats_long --sf-dir /root/testdata/sf0.01 [--show 20]
    python -m candlestack run monthly_stats --sf-dir ... --out /shared/monthly --format parquet

``run`` either shows the first rows or writes the whole result with Spark's
writer (nothing is collected to the driver when writing).
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="candlestack")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="names of the registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("name")
    run.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    run.add_argument("--show", type=int, default=20, help="rows to print (no --out)")
    run.add_argument("--out", help="write the result here instead of printing")
    run.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    run.add_argument("--master", default=os.environ.get("CANDLESTACK_MASTER", "*"))
    args = parser.parse_args(argv)

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from candlestack.plans.queries import QUERIES

    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if args.name not in QUERIES:
        parser.error(f"unknown query {args.name!r}; see `python -m candlestack list`")
    from candlestack.session import local_session

    spark = local_session(args.master)
    df = QUERIES[args.name](spark, args.sf_dir)
    if args.out:
        writer = df.write.mode("overwrite").format(args.format)
        if args.format == "csv":
            writer = writer.option("header", "true")
        writer.save(args.out)
        print(args.out)
    else:
        df.show(args.show, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
