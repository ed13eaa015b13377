"""Rows per task under a hot key: plain plans vs the skew-safe operators.

Usage: python tools/skew_report.py [sf_dir]   (writes SKEW.md)

The input is lineitem with one key ("hot") holding about a third of the rows.
* next-in-sequence: ``lead() OVER (PARTITION BY key)`` hash-partitions by key
  (one task gets the whole hot key) vs the (key, slice) partitioning of
  ``operators.sequence``;
* keep-first: rows entering the shuffle by key, and time, of ``row_number`` and of
  the aggregate of ``operators.dedup``; both have a map-side step.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from medalla.session import local_session  # noqa: E402


def spread(df, n_label):
    sizes = sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())
    total = sum(sizes)
    return f"| {n_label} | {len(sizes)} | {max(sizes):,} | {sizes[len(sizes) // 2]:,} | {max(sizes) / total:.1%} |"


def ranked(df):
    w = Window.partitionBy("k").orderBy("s", "v")
    return df.withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")


def aggregated(df):
    return df.groupBy("k").agg(F.min(F.struct("s", "v")))


def limited(df) -> int:
    """Rows of the hot key that ``WindowGroupLimit`` lets into the exchange: one for each map task that has it."""
    plan = ranked(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, plan
    return df.filter(F.col("k") == "hot").select(F.spark_partition_id()).distinct().count()


def timed(df) -> str:
    best = []
    for _ in range(3):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best.append(time.perf_counter() - t0)
    return f"{min(best):.1f}"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = 16
    spark = local_session(8, n)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the raw partitioning
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    df = li.select(
        F.when(F.col("l_partkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_partkey").cast("string")).alias("k"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("s"),
        F.col("l_extendedprice").alias("v"),
    )
    rows = [
        "# Rows per task with one key holding a third of the rows",
        "",
        f"Input: `lineitem` of `{sf}` ({li.count():,} rows), key `hot` for every `l_partkey % 3 = 0`;",
        f"{n} shuffle partitions, AQE off so the raw partitioning shows. Generated by `tools/skew_report.py`.",
        "",
        "| plan | tasks | max rows in one task | median | max share |",
        "|---|---|---|---|---|",
        spread(df.repartition(n, "k"), "window `lead` (hash by key)"),
        spread(df.repartition(n, "k", F.floor(F.col("s") / 4096)), "`next_in_sequence` (hash by key, slice of 4096)"),
    ]
    # keep-first: what enters the shuffle
    mapped = df.repartition(n)  # n map tasks
    raw_hot = mapped.filter(F.col("k") == "hot").count()
    partial_hot = (
        mapped.withColumn("pid", F.spark_partition_id())
        .filter(F.col("k") == "hot")
        .groupBy("pid")
        .agg(F.min(F.struct("s", "v")))
        .count()
    )
    rows += [
        "",
        f"| keep-first on key ({raw_hot:,} rows of the hot key) | hot-key rows shuffled to its reducer | seconds |",
        "|---|---|---|",
        f"| `row_number() = 1` (Spark plans `WindowGroupLimit` below the exchange) | {limited(mapped):,} | {timed(ranked(mapped))} |",
        f"| `groupBy(key).agg(min(struct))` (partial aggregate per map task) | {partial_hot:,} | {timed(aggregated(mapped))} |",
        "",
    ]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "SKEW.md")
    with open(path, "w") as fh:
        fh.write("\n".join(rows) + "\n")
    print("\n".join(rows))


if __name__ == "__main__":
    main()
