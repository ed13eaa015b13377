"""Queries that go through the real connectors.

Each one writes a feed derived from the test tables into a fresh scratch
folder under the cluster's shared ``spark.checkpoint.dir`` (landing files or
an embedded in-process database), ingests it with the production readers and
flows, and returns the resulting table.  Their results must equal the batch
queries of ``catalog`` (minus ingestion-time lineage, which is stamped at
ingestion).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig, checkpoint_root
from ..operators import quality
from ..sources import adapters, files, jdbc, schemas, storage
from ..streaming import flows
from . import silver
from .catalog import portable

LANDING_SPLITS = 4
#: Micro-batches that a feed's landing is worked off in where there are to be several.
MICRO_BATCHES = 4


def scratch_config(spark: SparkSession, label: str) -> PipelineConfig:
    root = f"{checkpoint_root(spark)}/scratch/{label}-{uuid.uuid4().hex[:12]}"
    return PipelineConfig.from_spark(
        spark, warehouse=f"{root}/warehouse", landing=f"{root}/landing", checkpoints=f"{root}/streams"
    )


def _raw(df: DataFrame, source: str) -> DataFrame:
    """A feed's own columns as the upstream system names them."""
    return schemas.to_source_names(df, source)


def _preferred(df: DataFrame, spec: silver.SourceSpec) -> DataFrame:
    """The raw row of each key's accepted copy that the batch plan prefers."""
    order = list(spec.lineage) + [c for c, _ in spec.columns if c != spec.key]
    as_sent = silver.as_sent(spec)  # held once
    changed = [c for c in spec.raw_columns if c not in as_sent]
    # rejects go before the shuffle; the rest is shuffled as it was sent, and typed after it
    sent = silver.prepare(spec, df).filter(quality.valid_predicate(spec.rules)).select(f"{silver.RAW}.*")
    valid = silver.prepare(spec, sent.repartition(spec.key))
    raw = F.struct(*[F.col(f"{silver.RAW}.{c}").alias(c) for c in changed]).alias(silver.RAW)
    picked = valid.groupBy(spec.key).agg(F.min(F.struct(*order, raw)).alias("p"))
    place = lambda c: f"p.{silver.RAW}.{c}" if c in changed else c if c == spec.key else f"p.{c}"
    return picked.select(*[F.col(place(c)).alias(c) for c in spec.raw_columns])


def _drop(spark: SparkSession, cfg: PipelineConfig, source: str, rows: DataFrame, number: int, compression: str = "none") -> None:
    """One landing drop of a CSV feed, taken through its checks."""
    files.write_csv(_raw(rows, source), f"{cfg.landing_path(source)}/drop={number}", compression=compression)
    flows.run_streams([flows.start_bronze(spark, cfg, source)])
    flows.run_streams([flows.start_checked(spark, cfg, source)])


def _share(df: DataFrame) -> int:
    """Files a micro-batch if there are to be ``MICRO_BATCHES`` (or as many as there are files)."""
    return max(1, -(-len(df.inputFiles()) // MICRO_BATCHES))


def _stream_in_copies(spark: SparkSession, cfg: PipelineConfig, source: str, bronze: DataFrame) -> DataFrame:
    """The preferred copy of every key arrives first, then the whole feed: the
    stream must keep the rows that the batch plan keeps."""
    spec = silver.SPECS[source]
    for number, rows in enumerate((_preferred(bronze, spec), bronze)):
        _drop(spark, cfg, source, rows, number, "gzip")
        flows.run_streams([flows.start_silver(spark, cfg, source)])
    return portable(storage.read(spark, cfg.table_path("silver", source)).select(*[c for c, _ in spec.columns]))


def history_stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee events arrive in two landings of two CSV drops, each drop spanning
    the whole time range (so the later ones are late for every employee); each
    landing is taken in by its own availableNow run and patched into the history."""
    cfg = scratch_config(spark, "history")
    events = adapters.employees(spark, sf_dir)
    drop_no = F.abs(F.xxhash64("employee_id", "event_at", "event_kind")) % LANDING_SPLITS
    for i in range(0, LANDING_SPLITS, 2):
        for number in (i, i + 1):
            files.write_csv(_raw(events.filter(drop_no == number), "employees"), f"{cfg.landing_path('employees')}/drop={number}")
        flows.run_streams([flows.start_bronze(spark, cfg, "employees")])
        flows.run_streams([flows.start_checked(spark, cfg, "employees")])
        flows.patch_pending_history(spark, cfg)
    return portable(flows.read_history(spark, cfg))


def reviews_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as multi-line JSON array files -> Bronze stream -> Silver stream."""
    cfg = scratch_config(spark, "reviews")
    files.write_json_arrays(_raw(adapters.reviews(spark, sf_dir), "reviews"), cfg.landing_path("reviews"))
    flows.run_streams([flows.start_bronze(spark, cfg, "reviews")])
    flows.run_streams([flows.start_checked(spark, cfg, "reviews")])
    flows.run_streams([flows.start_silver(spark, cfg, "reviews")])
    out = storage.read(spark, cfg.table_path("silver", "reviews"))
    return portable(out.drop("replies", "ingested_at", "source_file", "updated_at"))


def sales_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as CSV drops -> Bronze stream -> checked stream: the quarantine
    (every rejected row, one each)."""
    cfg = scratch_config(spark, "sales")
    sales = adapters.sales(spark, sf_dir)
    drop_no = F.abs(F.xxhash64("sale_id", "amount")) % 2
    for i in range(2):
        _drop(spark, cfg, "sales", sales.filter(drop_no == i), i)
    q = spark.read.parquet(cfg.table_path("quarantine", "sales"))
    return portable(q.select("source_table", "reason", "failed_rules", "record_key"))


def sales_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as CSV drops -> Bronze -> checked -> Silver streams, every business
    column."""
    return _stream_in_copies(spark, scratch_config(spark, "sales-silver"), "sales", adapters.sales(spark, sf_dir))


def sales_stream_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file that each Bronze sale came from: a landing file for each line number."""
    cfg = scratch_config(spark, "lineage")
    raw = _raw(adapters.sales(spark, sf_dir), "sales")
    files.write_named_csv(raw, cfg.landing_path("sales"), F.concat(F.lit("ventas-"), F.substring_index("venta_id", "-", -1)))
    flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
    return portable(flows.read_bronze(spark, cfg, "sales").select("sale_id", "source_file"))


def returns_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for returns."""
    return _stream_in_copies(spark, scratch_config(spark, "returns-silver"), "returns", adapters.returns(spark, sf_dir))


def review_replies_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with nested replies, some without a key, as multi-line JSON ->
    Bronze stream -> one row per reply."""
    cfg = scratch_config(spark, "replies")
    threaded = adapters.threaded_reviews(spark, sf_dir)
    keyless = threaded.filter(F.xxhash64("review_id") % 10 == 0).withColumn("review_id", F.lit(None).cast("string"))
    rows = _raw(threaded.unionByName(keyless), "reviews")
    files.write_json_arrays(rows, cfg.landing_path("reviews"))
    flows.run_streams([flows.start_bronze(spark, cfg, "reviews")])
    flows.run_streams([flows.start_review_replies(spark, cfg)])
    out = storage.read(spark, cfg.table_path("silver", "review_replies"))
    return portable(out.select("review_id", "reply_pos", "author", "text"))


def stream_rule_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counters of all streamed feeds, summed over their micro-batches:
    ``MICRO_BATCHES`` a feed, however many files there are, so that a batch grows
    with the feed and not their number."""
    cfg = scratch_config(spark, "counters")
    for name in ("sales", "returns", "employees", "reviews"):
        rows, landing = _raw(adapters.BY_SOURCE[name](spark, sf_dir), name), cfg.landing_path(name)
        if name == "reviews":
            files.write_json_arrays(rows, landing)
        else:
            files.write_csv(rows, f"{landing}/drop=0")
        flows.run_streams([flows.start_bronze(spark, cfg, name, max_files=_share(spark.read.text(landing)))])
        flows.run_streams([flows.start_checked(spark, cfg, name, max_files=_share(flows.read_bronze(spark, cfg, name)))])
    return portable(flows.stream_rule_counters(spark, cfg))


def _incremental(spark: SparkSession, sf_dir: str, label: str) -> PipelineConfig:
    """Sales and returns in three drops, each a run of its own."""
    from .. import flows as run  # the run imports the plans

    cfg = scratch_config(spark, label)
    files.write_json_lines(_raw(adapters.products(spark, sf_dir), "products"), cfg.landing_path("products"))
    feeds = {n: adapters.BY_SOURCE[n](spark, sf_dir) for n in ("sales", "returns")}
    for i in range(3):
        for name, rows in feeds.items():
            # a key's preferred copy in drop 0 or 1, then the whole feed
            if i < 2:
                spec = silver.SPECS[name]
                rows = _preferred(rows.filter(F.pmod(F.xxhash64(spec.key), F.lit(2)) == i), spec)
            files.write_csv(_raw(rows, name), f"{cfg.landing_path(name)}/drop={i}", compression="gzip")
        run.run_once(spark, cfg.with_options(run_ts=flows.stamp()))
    return cfg


def sales_by_branch_month_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart after three runs that each recomputed the months they touched."""
    cfg = _incremental(spark, sf_dir, "months")
    mart = spark.read.parquet(cfg.table_path("gold", "sales_by_branch_month"))
    return portable(mart.select("branch_id", "year", "month", "sales_count", "units_sold", "sales_total", "avg_ticket"))


def product_sales_returns_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product mart after three runs, from their partials; read back from
    its published version."""
    cfg = _incremental(spark, sf_dir, "products-mart")
    return portable(storage.read(spark, cfg.table_path("gold", "product_sales_returns")))


def products_json_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue as JSON Lines, read as a snapshot and cleaned."""
    cfg = scratch_config(spark, "products")
    files.write_json_lines(_raw(adapters.products(spark, sf_dir), "products"), cfg.landing_path("products"))
    bronze = files.read_products(spark, cfg.landing_path("products"))
    return portable(silver.clean(silver.PRODUCTS, bronze).drop("ingested_at"))


def _tracking_table(spark: SparkSession, sf_dir: str) -> str:
    """Tracking rows in a new in-memory Derby database of this process; its URL."""
    url = f"jdbc:derby:memory:medalla_{uuid.uuid4().hex[:12]};create=true"
    src = adapters.tracking(spark, sf_dir)
    table = src.select(
        "tracking_id",
        F.col("order_id").cast("bigint").alias("pedido_id"),
        "courier",
        F.col("delivery_state").alias("estado_entrega"),
        F.col("origin_branch").alias("sucursal_origen"),
        F.col("updated_at_src").cast("timestamp_ntz").alias("fecha_actualizacion"),
    )
    jdbc.write_table(table, url, "TRACKING", {"createTableColumnTypes": "tracking_id VARCHAR(40)"})
    return url


def _tracking_read(spark: SparkSession, url: str, column: str, parts: int) -> DataFrame:
    raw = jdbc.read_table(spark, url, "TRACKING", {"preferTimestampNTZ": "true"}, partition_column=column, num_partitions=parts)
    bronze = jdbc.tracking_bronze(raw, adapters.TRACKING_SYSTEM)
    return portable(silver.clean(silver.TRACKING, bronze).drop("ingested_at"))


def tracking_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking rows in an embedded in-memory Derby database (inside the
    Spark JVM, no network port), read back over JDBC in 4 parallel range
    queries on the numeric order id."""
    return _tracking_read(spark, _tracking_table(spark, sf_dir), '"pedido_id"', 4)


def tracking_jdbc_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in 8 parallel ranges of the text key and one query for NULLs."""
    return _tracking_read(spark, _tracking_table(spark, sf_dir), '"tracking_id"', 8)


QUERIES = {
    "history_stream_apply": history_stream_apply,
    "reviews_stream_ingest": reviews_stream_ingest,
    "sales_stream_rejects": sales_stream_rejects,
    "sales_stream_ingest": sales_stream_ingest,
    "sales_stream_lineage": sales_stream_lineage,
    "returns_stream_ingest": returns_stream_ingest,
    "review_replies_stream": review_replies_stream,
    "stream_rule_counters": stream_rule_counters,
    "sales_by_branch_month_incremental": sales_by_branch_month_incremental,
    "product_sales_returns_incremental": product_sales_returns_incremental,
    "products_json_snapshot": products_json_snapshot,
    "tracking_jdbc": tracking_jdbc,
    "tracking_jdbc_text_key": tracking_jdbc_text_key,
}


def stage_landing(spark: SparkSession, cfg: PipelineConfig, sf_dir: str, drop: str = "drop=0") -> None:
    """Write every file feed derived from the test tables into the landing
    folder of ``cfg`` (sales/returns/employees CSV, reviews multi-line JSON,
    products JSON Lines) under the sub-folder ``drop``."""
    for name in ("sales", "returns", "employees"):
        files.write_csv(_raw(adapters.BY_SOURCE[name](spark, sf_dir), name), f"{cfg.landing_path(name)}/{drop}")
    files.write_json_arrays(_raw(adapters.reviews(spark, sf_dir), "reviews"), f"{cfg.landing_path('reviews')}/{drop}")
    files.write_json_lines(_raw(adapters.products(spark, sf_dir), "products"), cfg.landing_path("products"), mode="overwrite")
