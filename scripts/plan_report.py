"""Write PLANS.md: the physical-plan shape of each headline query.

For every query: exchanges (shuffles), scans with their pushed filters and
read schema, join strategies, aggregate operators and windows, taken from
``explain("formatted")`` of the final plan (AQE off, so the static plan shows).
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from custval import registry
    from custval.session import build_session
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as for tables too large to broadcast
    qs = registry.queries()
    out = ["# Physical plans of the headline queries", "",
           f"Static plans (AQE off, no size-based broadcast) at `{sf_dir}`; counts are operators in the final query's plan.",
           "Fitted tables (cells, scores) read back from checkpoints appear as `Scan ExistingRDD`.", ""]
    for key in [*bench.HEADLINE, "churn_panel_partitioned"]:
        registry.reset_caches()
        text = plan_text(qs[key](spark, sf_dir))
        tree = text.split("\n\n")[0]
        ops = Counter()
        for name in ("Exchange", "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
                     "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
                     "SortAggregate", "ObjectHashAggregate", "Window", "WindowGroupLimit", "Generate",
                     "TakeOrderedAndProject", "Scan parquet", "Scan ExistingRDD"):
            ops[name] = len(re.findall(r"[-+:] \*?\s*" + re.escape(name) + r"\b", tree))
        out.append(f"## {key}")
        out.append("")
        out.append(", ".join(f"{k}: {v}" for k, v in ops.items() if v))
        out.append("")
        for m in re.finditer(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?=\n\(\d+\))", text, re.S):
            body = m.group(1)
            pf = re.search(r"PushedFilters: (.*)", body)
            rs = re.search(r"ReadSchema: (.*)", body)
            part = re.search(r"PartitionFilters: (.*)", body)
            if part:
                out.append(f"- partitions: `{part.group(1)}`")
            out.append(f"- scan: filters `{pf.group(1) if pf else '[]'}`; schema `{rs.group(1) if rs else ''}`")
        out.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
