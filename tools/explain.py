"""Print the formatted physical plan of catalog queries after running that very plan (so
AQE's final plan is shown). Usage: python tools/explain.py [sf_dir] name [name ...]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from autolake.plans.catalog import QUERIES  # noqa: E402
from autolake.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=16)
    for name in args:
        df = QUERIES[name](spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()     # runs this very plan: AQE's final one is shown
        print(f"===== {name}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
