"""Summarise the executed physical plan of every batch query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
For each query: shuffles (Exchange), aggregates, joins, Python nodes,
checkpoint reads, and every scan's pruned ReadSchema and PushedFilters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medalla.plans.catalog import QUERIES  # noqa: E402
from medalla.session import local_session  # noqa: E402

NODES = [
    ("Exchange hashpartitioning", r"Exchange hashpartitioning"),
    ("Exchange rangepartitioning", r"Exchange rangepartitioning"),
    ("Exchange SinglePartition", r"Exchange SinglePartition"),
    ("BroadcastExchange", r"BroadcastExchange"),
    ("HashAggregate", r"HashAggregate"),
    ("SortAggregate", r"SortAggregate"),
    ("BroadcastHashJoin", r"BroadcastHashJoin"),
    ("SortMergeJoin", r"SortMergeJoin"),
    ("Window", r"\bWindow\b"),
    ("TakeOrderedAndProject", r"TakeOrderedAndProject"),
    ("MapInPandas", r"MapInPandas"),
    ("MapInArrow", r"MapInArrow"),
    ("checkpoint read (ExistingRDD)", r"Scan ExistingRDD"),
]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # no "..." in ReadSchema
    out = [
        "# Physical plans of the registered batch queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf}` (local[8], AQE on, final adaptive plans).",
        "Counts are operator occurrences in the executed plan; scans list the columns read and the filters pushed",
        "into Parquet.",
        "",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [(label, len(re.findall(rx, plan))) for label, rx in NODES]
        out.append(f"## {name}")
        out.append("")
        out.append(", ".join(f"{label}: {n}" for label, n in counts if n) or "no shuffle")
        out.append("")
        for m in re.finditer(r"FileScan parquet [^\n]*", plan):
            line = m.group(0)
            table = re.search(r"Location: InMemoryFileIndex[^\]]*/([a-z_]+)\.parquet", line)
            cols = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            out.append(
                f"* scan `{table.group(1) if table else '?'}`: ReadSchema `{cols.group(1) if cols else '?'}`"
                + (f", PushedFilters `{pushed.group(1)}`" if pushed and pushed.group(1) != "[]" else "")
            )
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
