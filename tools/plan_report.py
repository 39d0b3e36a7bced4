"""Summarise the physical plan of every registered query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each key: parquet scans, shuffle exchanges, broadcast exchanges,
partial top-k limits, and whether every scan reads a pruned schema.  Plans
of the iterative algorithms show only the final step (the loop's rounds are
separate jobs over checkpointed/bucketed tables).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bibgraph.plans.queries import REGISTRY  # noqa: E402
from bibgraph.session import build_session  # noqa: E402

ITERATIVE = {"pagerank_wrote", "pagerank_top10", "pagerank_cites", "scc_cites", "scc_top10",
             "scc_wrote", "assign_reviewers", "assign_comments", "synthetic_citations",
             "citation_reach_khop", "csv_round_trip", "scc_same_edition", "scc_loaded_cites"}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("| key | parquet scans | shuffles | broadcasts | partial top-k | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- |")
    for key, q in REGISTRY.items():
        df = q(spark, sf_dir)
        text = plan_text(df)
        scans = len(re.findall(r"FileScan parquet", text))
        shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                  r"Exchange SinglePartition|Exchange RoundRobin", text))
        bcast = len(re.findall(r"BroadcastExchange", text))
        limit = len(re.findall(r"WindowGroupLimit|TakeOrderedAndProject", text))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
        note = " (final step only)" if key in ITERATIVE else ""
        print(f"| `{key}`{note} | {scans} | {shuffles} | {bcast} | {limit} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
