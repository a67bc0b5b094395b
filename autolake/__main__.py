"""Command line for the daily jobs and the query catalog.

  python -m autolake fx       --lake PATH --day YYYY-MM-DD                land, clean and load the rates
  python -m autolake extract  --lake PATH --day YYYY-MM-DD --source a     page files -> landed records
  python -m autolake listings --lake PATH --day YYYY-MM-DD --source a     extract -> silver -> load -> gold -> train -> score
  python -m autolake gold | train | score | compare | retrain --lake PATH --day YYYY-MM-DD
  python -m autolake query    NAME --data DIR [--show 20]

Jobs read what earlier steps landed under ``--lake`` (a shared filesystem path) and
stop at the first failure, leaving committed data untouched.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="autolake")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("fx", "extract", "listings", "gold", "train", "score", "compare", "retrain"):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True)
        s.add_argument("--day", required=True)
        if name in ("extract", "listings"):
            s.add_argument("--source", required=True)
        if name in ("listings", "train", "compare", "retrain"):
            s.add_argument("--trees", type=int, default=300)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--data", required=True, help="folder with the input tables")
    q.add_argument("--show", type=int, default=20)
    args = p.parse_args(argv)

    from autolake.session import build_session
    spark = build_session()
    from autolake.plans import jobs
    if args.cmd == "query":
        from autolake.plans.catalog import QUERIES
        QUERIES[args.name](spark, args.data).show(args.show, truncate=False)
        return 0
    run = {
        "fx": lambda: jobs.fx_job(spark, args.lake, args.day),
        "extract": lambda: {"landed": jobs.extract_job(spark, args.lake, args.source, args.day)},
        "listings": lambda: jobs.listings_job(spark, args.lake, args.day, args.source, max_iter=args.trees),
        "gold": lambda: {"gold": jobs.gold_job(spark, args.lake, args.day)},
        "train": lambda: jobs.train_job(spark, args.lake, args.day, max_iter=args.trees),
        "score": lambda: jobs.score_job(spark, args.lake, args.day),
        "compare": lambda: jobs.compare_job(spark, args.lake, args.day, max_iter=args.trees),
        "retrain": lambda: jobs.retrain_job(spark, args.lake, args.day, max_iter=args.trees),
    }
    out = run[args.cmd]()
    print(json.dumps(out, default=str, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
