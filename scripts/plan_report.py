"""Summarise the final (adaptive) physical plan of every registered query.

    python scripts/plan_report.py [sf_dir] > PLANS.md

Each query is collected once (so AQE settles its plan), then its formatted
plan is scanned for exchanges, join strategies, windows, subqueries and the
filters / columns pushed into the parquet scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadlake.plans.inspect import plan_text  # noqa: E402
from leadlake.queries import QUERIES  # noqa: E402
from leadlake.session import build_session  # noqa: E402

BLOCK = re.compile(r"^\((\d+)\) ([A-Za-z]+)")


def blocks(text: str) -> dict[int, tuple[str, str]]:
    """Node id -> (operator name, its detail lines), one entry per node."""
    out: dict[int, tuple[str, str]] = {}
    current = None
    for line in text.splitlines():
        m = BLOCK.match(line)
        if m:
            current = int(m.group(1))
            out[current] = (m.group(2), "")
        elif current is not None and line.strip():
            name, body = out[current]
            out[current] = (name, body + line + "\n")
    return out


TREE_ID = re.compile(r"\((\d+)\)\s*$")


def final_plan_ids(text: str) -> set[int]:
    """Ids of the nodes in the final plan trees (after execution AQE prints
    both the final and the initial plan of every adaptive section)."""
    ids, skip = set(), False
    for line in text.splitlines():
        if "== Initial Plan ==" in line:
            skip = True
        elif "== Final Plan ==" in line or not line.strip():
            skip = False
        elif not skip and not line.startswith("("):
            m = TREE_ID.search(line)
            if m:
                ids.add(int(m.group(1)))
    return ids


def summarize(text: str) -> dict:
    keep = final_plan_ids(text)
    nodes = {i: v for i, v in blocks(text).items() if i in keep}
    names = [n for n, _ in nodes.values()]
    exchanges = [body for n, body in nodes.values() if n == "Exchange"]
    scans = [body for n, body in nodes.values() if n == "Scan"]
    return {
        "shuffles": len(exchanges),
        "single_partition": sum("SinglePartition" in b for b in exchanges),
        "broadcasts": names.count("BroadcastExchange"),
        "bhj": names.count("BroadcastHashJoin"),
        "smj": names.count("SortMergeJoin"),
        "windows": names.count("Window"),
        "group_limit": "yes" if "WindowGroupLimit" in names else "",
        "subqueries": text.partition("===== Subqueries =====")[2].count("Subquery:"),
        "partition_filters": "yes" if any(re.search(r"PartitionFilters: \[.+\]", b)
                                          for b in scans) else "",
        "pushed_filters": "yes" if any(re.search(r"PushedFilters: \[.+\]", b)
                                       for b in scans) else "",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["shuffles", "single_partition", "broadcasts", "bhj", "smj", "windows",
            "group_limit", "subqueries", "partition_filters", "pushed_filters"]
    print("# Physical plans of the registered queries\n")
    print(f"Final adaptive plans at `{os.path.basename(sf)}` on local[8] "
          "(`scripts/plan_report.py`). `shuffles` counts exchanges (all stages, including "
          "subqueries and broadcast builds' inputs); `single_partition` counts exchanges to one "
          "partition, which here only ever carry one partial-aggregate row per task (global "
          "counts / means / report rows); `bhj`/`smj` are broadcast-hash / sort-merge joins "
          "(AQE broadcasts a side only after measuring it below the threshold).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        s = summarize(plan_text(df))
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
