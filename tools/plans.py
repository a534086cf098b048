"""Print the formatted physical plan of registered queries (scans, pushed filters,
exchanges, aggregates) - the review step after each operator works.

Usage: python tools/plans.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import QUERIES, load_all  # noqa: E402
from tessera.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    load_all()
    spark = get_spark("local[8]", 16)
    for name, fn in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scans = [line.strip() for line in lines if "FileScan parquet" in line]
        print(f"== {name}: {sum('Exchange' in line for line in lines)} exchanges, {len(scans)} scans")
        for s in scans:
            table = s.split("[file:")[-1].split("]")[0].rsplit("/", 1)[-1] if "[file:" in s else "?"
            pushed = s.split("PushedFilters: ")[1].split("]")[0] + "]" if "PushedFilters: " in s else ""
            read = s.split("ReadSchema: ")[1] if "ReadSchema: " in s else ""
            print(f"   scan {table}: pushed {pushed} read {read}")
        if "--full" in pats:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
