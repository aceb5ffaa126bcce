"""Command line: ``python -m lodestar daily --launches DIR --starlink DIR [--rockets DIR]``.

Runs the daily chain once (see ``lodestar.plans.daily``) on landed reply files
and prints the headline, upsert counts and quality metrics as JSON.  On a
cluster, submit it with spark-submit; ``spark.checkpoint.dir`` (or
``spark.lodestar.warehouse``) must name the shared folder for the tables.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m lodestar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="land, upsert, gate, publish silver and gold, print the headline")
    d.add_argument("--launches", required=True)
    d.add_argument("--starlink", required=True)
    d.add_argument("--rockets")
    d.add_argument("--layout", default="lines", choices=["lines", "array_lines", "array"])
    d.add_argument("--lenient", action="store_true", help="store malformed documents as rejects instead of failing")
    d.add_argument("--as-of", help="analysis time, ISO format (default: now, UTC)")
    d.add_argument("--target", type=int, default=42000)
    d.add_argument("--recent-year", type=int, default=2022)
    d.add_argument("--master", help="Spark master for a local run, e.g. local[8]")
    r = sub.add_parser("runs", help="runs of the last HOURS hours, newest first (top K)")
    r.add_argument("--hours", type=int, default=24)
    r.add_argument("-k", type=int, default=10)
    r.add_argument("--as-of")
    r.add_argument("--master")
    s = sub.add_parser("summary", help="document counts and last extraction of each collection")
    s.add_argument("--master")
    args = ap.parse_args(argv)

    if args.cmd == "runs":
        from lodestar.functions.exprs import as_of_ts
        from lodestar.plans.daily import run_log_path
        from lodestar.session import get_spark
        from lodestar.sources.runlog import read_run_log, recent_runs
        spark = get_spark(args.master)
        as_of = as_of_ts(args.as_of) if args.as_of else None
        try:
            rows = recent_runs(read_run_log(spark, run_log_path(spark)), as_of, args.hours, args.k).collect()
        except Exception as exc:  # noqa: BLE001 - a status report never fails: empty list
            print(f"run log unavailable: {exc}", file=sys.stderr)
            rows = []
        print(json.dumps({"recent_runs": [r.asDict() for r in rows]}, default=str))
        return 0
    if args.cmd == "summary":
        from lodestar.operators.quality import extraction_summary, summary_dict
        from lodestar.plans.daily import latest_states
        from lodestar.session import get_spark
        spark = get_spark(args.master)
        states = latest_states(spark)
        names = {"launches": "last_launch_update", "starlink": "last_starlink_update"}
        print(json.dumps(summary_dict(extraction_summary(
            states, {k: v for k, v in names.items() if k in states})) if states else {}, default=str))
        return 0

    from lodestar.plans.daily import daily_run
    from lodestar.session import get_spark
    spark = get_spark(args.master)
    landed = {"launches": args.launches, "starlink": args.starlink}
    if args.rockets:
        landed["rockets"] = args.rockets
    as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else None
    out = daily_run(spark, landed, as_of=as_of, layout=args.layout, strict=not args.lenient, target=args.target,
                    recent_year=args.recent_year)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
