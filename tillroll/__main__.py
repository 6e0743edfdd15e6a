"""Command line of the daily jobs.

    spark-submit tillroll/__main__.py silver --bronze B --silver S --date 2024-01-31
    spark-submit tillroll/__main__.py gold --silver S --gold G --as-of 2024-01-31 --now "2024-01-31 03:00:00"
"""

from __future__ import annotations

import argparse

from tillroll import vocabulary as V
from tillroll.operators.quality import verdict
from tillroll.plans import daily
from tillroll.session import build_session, scratch_scope, sizing


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillroll")
    jobs = parser.add_subparsers(dest="job", required=True)
    s = jobs.add_parser("silver", help="landed files to silver tables")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--date", help="landed date, all dates when left out")
    s.add_argument("--entities", nargs="+", default=list(V.ENTITIES), choices=V.ENTITIES)
    s.add_argument("--no-gate", action="store_true", help="run although required entities have not landed")
    g = jobs.add_parser("gold", help="silver tables to gold tables and checks")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--as-of", required=True)
    g.add_argument("--environment", default="dev")
    g.add_argument("--lookback-runs", type=int, default=0, help="silver runs that are merged into the fact again")
    for p in (s, g):
        p.add_argument("--now", required=True, help="time stamp of the run, UTC")
        p.add_argument("--shuffle-gb", type=int, default=50, help="what the widest shuffle of the job moves")
        p.add_argument("--cores", type=int, default=8, help="cores of all executors")
        p.add_argument("--key-buckets", type=int, default=1024, help="buckets of the key indexes of merged tables")
    args = parser.parse_args(argv)

    spark = build_session(f"tillroll-{args.job}")
    for name, value in sizing(args.shuffle_gb << 30, args.cores).items():
        spark.conf.set(name, value)
    spark.conf.set(daily.KEY_BUCKETS, str(args.key_buckets))
    with scratch_scope(spark):
        if args.job == "silver":
            daily.run_silver(
                spark, args.bronze, args.silver, args.now, args.date, args.entities, not args.no_gate).show()
            return 0
        results = daily.run_gold(
            spark, args.silver, args.gold, args.as_of, args.now, args.environment, args.lookback_runs)
        results.filter("not passed").show(100, truncate=False)
        return 0 if verdict(results).first()["passed"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
