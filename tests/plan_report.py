"""Physical plans of the headline queries, as Markdown.

    python tests/plan_report.py [sf_dir] > PLANS.md

For each query: the operator tree of ``explain("formatted")`` and, for every
scan, what reached it (pushed filters, partition filters, columns read).
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = [
    "fact_daily", "fact_yearly", "job_fact_yearly", "q_top_hottest", "q_compare_yearly", "q_max_stored_fact",
    "q_top_hottest_stored", "q_compare_yearly_stored", "win_avg_yearly", "win_dedup_daily", "pivot_native",
    "limit_sample",
]
SCAN_FIELDS = ("PushedFilters", "PartitionFilters", "ReadSchema")


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(plan: str) -> tuple[str, list[str]]:
    lines = plan.splitlines()
    tree = []
    for line in lines[1:]:
        if not line.strip():
            break
        tree.append(line)
    scans, current = [], None
    for line in lines:
        m = re.match(r"^\((\d+)\) Scan (\w+)", line)
        if m:
            current = f"({m.group(1)}) {m.group(2)}"
            scans.append(current)
        elif current and line.split(":")[0] in SCAN_FIELDS:
            scans.append("    " + re.sub(r"#\d+", "", line))
        elif not line.strip():
            current = None
    return "\n".join(tree), scans


def main(sf_dir: str) -> None:
    import __spark_entry__ as entry
    from meteora.session import local_session

    spark = local_session(8, 8)
    qs = entry.queries()
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `python tests/plan_report.py {sf_dir}` (local session, 8 shuffle partitions). "
          "Initial adaptive plans: AQE may still coalesce partitions, split skewed ones or turn a measured-small "
          "join side into a broadcast at run time.\n")
    for name in QUERIES:
        tree, scans = summary(formatted(qs[name](spark, sf_dir)))
        print(f"## {name}\n\n```\n{tree}\n```\n\nScans:\n\n```\n" + "\n".join(scans) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
