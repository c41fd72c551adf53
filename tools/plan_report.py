"""Plan summary of every registered operator over the domain tables stored as Parquet.

The bound tables of ``--sf`` are written once to a scratch store and read back
(the production shape: Parquet scans with pushed filters), every query key is
run, and its final adaptive plan is summarized: scans, shuffles by kind, reused
exchanges, join strategies, Python nodes. Prints a Markdown table.

Usage: python tools/plan_report.py [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = ("src_", "load_", "export_")


def summarize(plan: str) -> dict[str, str]:
    final = plan.split("\n+- == Initial Plan ==")[0] if "== Initial Plan ==" in plan else plan
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                       r"[^\n]*?\b(Inner|LeftOuter|LeftAnti|LeftSemi|FullOuter|RightOuter)\b", final)
    return {
        "scans": str(final.count("FileScan parquet")),
        "hash_shuffles": str(len(re.findall(r"Exchange hashpartitioning", final))),
        "range/single": str(len(re.findall(r"Exchange (rangepartitioning|SinglePartition)", final))),
        "broadcasts": str(final.count("BroadcastExchange")),
        "reused": str(final.count("ReusedExchange")),
        "joins": ", ".join(f"{a.replace('Join', '')}/{b}" for a, b in joins) or "-",
        "python": "yes" if re.search(r"EvalPython|PythonUDF|InPandas", final) else "no",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]", final) else "no",
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from ledgerlens.plans import registry
    from ledgerlens.session import local_session, scratch_path
    from ledgerlens.sources.binding import bind
    from ledgerlens.sources.tables import read_tables, write_tables

    spark = local_session()
    root = scratch_path(spark, "plan-report-store")
    write_tables(bind(spark, a.sf), root)
    # Seed the per-session binding memo so every registered query reads the stored tables.
    registry._BOUND[(id(spark), a.sf.rstrip("/"))] = (spark, read_tables(spark, root))
    keys = a.keys or [k for k in registry.QUERIES if not k.startswith(SKIP)]
    cols = ["scans", "hash_shuffles", "range/single", "broadcasts", "reused", "joins", "python", "pushed"]
    print("| key | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for k in keys:
        df = registry.QUERIES[k](spark, a.sf)
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{k}` | " + " | ".join(s[c] for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
