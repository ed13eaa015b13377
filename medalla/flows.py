"""One scheduled run of the whole medallion, as plain ordered calls.

    landing files --(availableNow streams)--> Bronze
    Bronze --(one stream a feed)--> accepted rows, quarantine, rule counters
    accepted --(streams)--> Silver + what Gold adds up; employee history
    product / tracking snapshots --> Bronze --> Silver (+ their rejects)
    Silver --> current staff --> Gold marts --> row-count check --> run log

Every table is written to its own path and read back from storage by the next
step, which also cuts the lineage between steps (a lost executor recomputes
from the last written table, not from the landing files).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .config import PipelineConfig
from .plans import employees, gold, governance, monitoring, quarantine, silver
from .sources import files, jdbc, schemas, storage
from .sources.storage import live_runs
from .streaming import flows

STREAMED = ("sales", "returns", "reviews", "employees")


def read_table(spark: SparkSession, cfg: PipelineConfig, layer: str, name: str) -> DataFrame:
    """A written table, without the columns that only place its files."""
    return storage.read(spark, cfg.table_path(layer, name)).drop(flows.BATCH)


def read_quarantine(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    parts = [read_table(spark, cfg, "quarantine", n) for n in silver.SPECS if _have(spark, cfg, "quarantine", n)]
    empty = spark.createDataFrame([], silver.QUARANTINE_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), parts, empty)


def _have(spark: SparkSession, cfg: PipelineConfig, layer: str, *names: str) -> bool:
    return all(storage.readable(spark, cfg.table_path(layer, n)) for n in names)


def touched_months(spark: SparkSession, cfg: PipelineConfig) -> tuple[list, int]:
    """Months with Silver sales of micro-batches that no published mart covers
    yet - at most one entry per calendar month, NULL for undated sales - and
    the last such micro-batch (-1 for none).  A run that died after its streams
    had committed leaves its batches here for the next one."""
    done = flows.latest_done(spark, cfg, "sales_by_branch_month")
    new = spark.read.parquet(cfg.table_path("ops", "sales_months")).filter(F.col(flows.BATCH) > done)
    rows = new.groupBy("sale_month").agg(F.max(flows.BATCH).alias(flows.BATCH)).collect()
    return [r["sale_month"] for r in rows], max([-1, *(r[flows.BATCH] for r in rows)])


def _monthly_sales(spark: SparkSession, cfg: PipelineConfig, summary: dict) -> None:
    """Monthly branch sales, recomputed only for months with new sales.

    Silver sales are partitioned by ``sale_month`` and the mart by
    (``year``, ``month``): the touched months are read with partition pruning
    and their Gold partitions replaced (dynamic overwrite); other months keep
    their files.  The first run, or ``cfg.full_refresh``, recomputes all.  What
    the mart covers is written down after the mart itself.
    """
    target = cfg.table_path("gold", "sales_by_branch_month")
    sales = read_table(spark, cfg, "silver", "sales")
    months, last = touched_months(spark, cfg)
    full = cfg.full_refresh or not storage.readable(spark, target)
    if not full:
        summary["gold_months_recomputed"] = len(months)
        if not months:
            return
        dated = [m for m in months if m is not None]
        cond = F.col("sale_month").isin(dated) if dated else F.lit(False)
        if len(dated) < len(months):
            cond = cond | F.col("sale_month").isNull()
        sales = sales.filter(cond)
    (
        gold.sales_by_branch_month(sales, repeats=bool(cfg.dedup_watermark))
        .hint("rebalance", "year", "month")  # few files per month partition
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if full else "dynamic")
        .partitionBy("year", "month")
        .parquet(target)
    )
    if last >= 0:
        flows.mark_done(spark, cfg, "sales_by_branch_month", last)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The live partials; only their folders are listed."""
    runs = live_runs(storage.partition_values(spark, path, "run"))
    return spark.read.option("basePath", path).parquet(*[f"{path}/run={r}" for r in runs])


def totals_by_product(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    """Per-product totals of one fact table, from the partials that the Silver
    stream writes with each micro-batch: the facts themselves are not read.
    More than ``cfg.partials_compact_after`` live micro-batches are folded into
    a compaction.  ``cfg.full_refresh`` makes the compaction from the facts; a
    bounded de-duplication, whose keys may repeat, counts them anew as well."""
    silver_name, partials = gold.PARTIAL_LOGS[name]
    path = cfg.table_path("ops", name)
    live = live_runs(storage.partition_values(spark, path, "run"))
    folded = None
    if cfg.dedup_watermark:
        return partials(read_table(spark, cfg, "silver", silver_name), repeats=True)
    if cfg.full_refresh:
        folded = partials(read_table(spark, cfg, "silver", silver_name))
    elif len(live) > cfg.partials_compact_after + 1:
        folded = gold.merge_partials(read_partials(spark, path))
    if folded is not None and live:
        folded = folded.withColumn("run", F.lit("c" + max(t[1:] for t in live)))
        folded.hint("rebalance", "run").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    return gold.merge_partials(read_partials(spark, path))


def unknown_product_sales(products: DataFrame, sales_totals: DataFrame) -> int:
    """Sales whose product is not in the catalogue, from the per-product totals;
    a product id that is NULL is unknown too."""
    unknown = sales_totals.join(products.select("product_id"), "product_id", "left_anti")
    return unknown.agg(F.coalesce(F.sum("sales_count"), F.lit(0))).first()[0]


def _counters_by_flow(spark: SparkSession, cfg: PipelineConfig) -> dict[str, dict]:
    """Rule counters of all micro-batches so far, by flow (one row per rule)."""
    out: dict[str, dict] = {}
    for r in flows.stream_rule_counters(spark, cfg).collect():
        metrics = out.setdefault(f"checked_{r['source_table']}", {}).setdefault(f"rules_{r['source_table']}", {})
        metrics |= {"rows_in": r["rows_in"], f"failed_{r['rule']}": r["failed"]}
    return out


def run_once(
    spark: SparkSession,
    cfg: PipelineConfig,
    tracking_reader: Callable[[SparkSession], DataFrame] | None = None,
) -> dict:
    """Run every step once; returns a summary (also written to the run log)."""
    log = monitoring.RunLog(spark, cfg.table_path("ops", "run_log"))
    summary: dict = {"run_ts": cfg.run_ts.isoformat(), "steps": {}}

    run_start = time.perf_counter()

    def step(name: str, fn: Callable[[], object]):
        t0 = time.perf_counter()
        try:
            out = fn()
        except Exception as err:  # record the failure in the run log, then fail the run
            log.add("step_failed", json.dumps({"step": name, "error": f"{type(err).__name__}: {err}"}), "ERROR")
            log.flush()
            raise
        secs = round(time.perf_counter() - t0, 3)
        summary["steps"][name] = secs
        log.add("step", json.dumps({"step": name, "seconds": secs}))
        return out

    present = [s for s in STREAMED if storage.exists(spark, cfg.landing_path(s))]
    for s in set(STREAMED) - set(present):
        log.add("source", f"no landing folder for {s}", level="WARN")

    # 1. Bronze: incremental file ingestion
    step("bronze_streams", lambda: flows.run_streams([flows.start_bronze(spark, cfg, s) for s in present]))

    # 2. Bronze snapshots
    if storage.exists(spark, cfg.landing_path("products")):
        step("bronze_products", lambda: storage.publish(files.read_products(spark, cfg.landing_path("products")), cfg.table_path("bronze", "products")))
    if tracking_reader is not None or cfg.jdbc_options:
        def tracking():
            if tracking_reader is not None:
                raw = tracking_reader(spark)
            else:
                opts = dict(cfg.jdbc_options)
                url = opts.pop("url")
                # by the table's key, unless another column is named
                key = jdbc.quoted(spark, url, schemas.SOURCE_NAMES["tracking"][silver.TRACKING.key])
                raw = jdbc.read_table(spark, url, opts.pop("dbtable"), opts, opts.pop("partitionColumn", key))
            storage.publish(jdbc.tracking_bronze(raw), cfg.table_path("bronze", "tracking"))

        step("bronze_tracking", tracking)

    # 3. Both verdicts and the rule counters of what is new in Bronze, in one pass each
    loaded = [s for s in STREAMED if _have(spark, cfg, "bronze", s)]
    step("checked_streams", lambda: flows.run_streams([flows.start_checked(spark, cfg, s) for s in loaded]))
    if _have(spark, cfg, "ops", "rule_counters"):
        for flow, metrics in _counters_by_flow(spark, cfg).items():
            log.add("rule_counters", json.dumps({"flow": flow, "metrics": metrics}))

    # Silver streams over the accepted rows; replies; then the employee history, once
    def silver_streams():
        qs = [flows.start_silver(spark, cfg, s) for s in ("sales", "returns", "reviews") if _have(spark, cfg, "checked", s)]
        if "reviews" in loaded:
            qs.append(flows.start_review_replies(spark, cfg))
        flows.run_streams(qs)

    step("silver_streams", silver_streams)
    step("merge_silver", lambda: flows.merge_silver(spark, cfg))
    if _have(spark, cfg, "silver", "employee_events"):
        summary["history_rows_written"] = step("employee_history", lambda: flows.patch_pending_history(spark, cfg))

    # 4. Silver snapshots
    for s in ("products", "tracking"):
        if _have(spark, cfg, "bronze", s):
            def snap(s=s):
                bronze = read_table(spark, cfg, "bronze", s)
                obs = Observation(f"rules_{s}")
                clean = silver.clean(silver.SPECS[s], bronze, dedup_first=cfg.dedup_first, run_ts=cfg.run_ts, observation=obs)
                storage.publish(clean, cfg.table_path("silver", s))
                log.add("rule_counters", json.dumps({"flow": f"silver_{s}", "metrics": {f"rules_{s}": obs.get}}))
                storage.publish(silver.rejects(silver.SPECS[s], bronze, cfg.run_ts), cfg.table_path("quarantine", s))

            step(f"silver_{s}", snap)

    # 5. Current staff (snapshot of the history), tagged personal data
    if _have(spark, cfg, "silver", "employee_history"):
        step(
            "silver_employees_current",
            lambda: storage.publish(
                governance.tag_pii(employees.current(flows.read_history(spark, cfg))),
                cfg.table_path("silver", "employees_current"),
            ),
        )

    # 6. Gold
    have = lambda *names: _have(spark, cfg, "silver", *names)
    gold_out: dict[str, DataFrame] = {}  # recomputed in full
    gold_names: list[str] = []
    totals: dict[str, DataFrame] = {}
    for name, (fact, _) in gold.PARTIAL_LOGS.items():
        if have(fact):
            totals[fact] = step(f"partials_{fact}", lambda name=name: totals_by_product(spark, cfg, name))
    if have("sales"):
        step("gold_sales_by_branch_month", lambda: _monthly_sales(spark, cfg, summary))
        gold_names.append("sales_by_branch_month")
    if have("products", "sales", "returns"):
        gold_out["product_sales_returns"] = gold.products_with_totals(
            read_table(spark, cfg, "silver", "products"), totals["sales"], totals["returns"]
        )
    if have("employees_current"):
        gold_out["headcount_by_branch"] = gold.headcount_by_branch(read_table(spark, cfg, "silver", "employees_current"))
    if have("reviews", "products"):
        gold_out["negative_review_rate"] = gold.rate_by_category(totals["reviews"], read_table(spark, cfg, "silver", "products"))
    for name, df in gold_out.items():
        step(f"gold_{name}", lambda df=df, name=name: storage.publish(df, cfg.table_path("gold", name)))
        gold_names.append(name)

    # 7. Checks
    if gold_names:
        counts = monitoring.row_counts({n: read_table(spark, cfg, "gold", n) for n in gold_names})
        storage.publish(counts, cfg.table_path("ops", "gold_row_counts"))
        rows = read_table(spark, cfg, "ops", "gold_row_counts").collect()  # one row per Gold table
        summary["gold_row_counts"] = {r["table_name"]: r["rows"] for r in rows}
        for r in rows:
            log.add("row_count", json.dumps({"table": r["table_name"], "rows": r["rows"]}), "INFO" if r["ok"] else "ERROR")
    if have("sales", "products"):
        orphans = unknown_product_sales(read_table(spark, cfg, "silver", "products"), totals["sales"])
        summary["orphan_sales"] = orphans
        log.add("orphan_keys", json.dumps({"table": "sales", "unknown_product_rows": orphans}), "WARN" if orphans else "INFO")

    if any(_have(spark, cfg, "quarantine", n) for n in silver.SPECS):
        breakdown = quarantine.summary(read_quarantine(spark, cfg)).collect()  # one row per feed and reason
        summary["quarantine"] = {f"{r['source_table']}/{r['reason']}": r["count"] for r in breakdown}
        summary["quarantine_total"] = sum(r["count"] for r in breakdown)
        log.add("quarantine", json.dumps({"total": summary["quarantine_total"], "by_reason": summary["quarantine"]}))

    summary["duration_s"] = round(time.perf_counter() - run_start, 3)
    slow = summary["duration_s"] > cfg.run_duration_warn_seconds
    log.add(
        "run",
        json.dumps({"run_ts": summary["run_ts"], "steps": len(summary["steps"]), "seconds": summary["duration_s"]}),
        "WARN" if slow else "INFO",
    )
    log.flush()
    return summary
