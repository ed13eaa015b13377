"""Structured Streaming flows: landing files -> Bronze -> checked -> Silver.

* Bronze: one file stream per feed, appended to a Parquet table.  The file
  sink's commit log plus the query checkpoint give exactly-once appends, and a
  file is never ingested twice across runs, whatever its modification time.
* Checked: one pass over each new part of a Bronze table types it, evaluates the
  rules and writes both verdicts and the rule counters, each into the
  micro-batch's own partition (dynamic overwrite), so a replayed batch rewrites
  its files and is counted once.
* Silver: the accepted rows as a stream, de-duplicated on the key: the first
  valid arrival wins, of one micro-batch the smallest.  No state is held: the keys
  taken so far are a table, and a micro-batch is joined with it behind a bitmap of
  the keys' hashes (``operators.seen``).  With ``cfg.dedup_watermark`` Spark's own
  bounded state is used in its place.  Each micro-batch is
  written into its own partition together with what Gold needs of it: additive
  per-product partials, and for sales the months touched.  Silver sales are
  partitioned by ``sale_month`` and rebalanced on it, so a batch writes a few
  files per month, not one for each task and month; between the streams' runs
  the batches' files are merged, eight of a size at a time.
* Employee history: once the streams have stopped, one job writes what the new
  events change in it - their own versions and those that now end at them - as a
  patch; readers take a version from the newest patch that has it.  Patches are
  folded into the table when they have grown to a share of it, so the rows
  written grow with the events and not with the history.

All queries run with ``trigger(availableNow=True)`` by default: process what
has arrived, then stop - a scheduled incremental job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import PipelineConfig
from ..operators import dedup, quality, scd2, seen
from ..plans import employees, gold, silver
from ..sources import files, schemas, storage

BUCKET = "bucket"
BATCH = "batch_id"
VALID = "valid"

AVAILABLE_NOW = {"availableNow": True}


def bronze_schema(source: str) -> T.StructType:
    lineage_name = schemas.SOURCE_SYSTEM if source == "tracking" else schemas.SOURCE_FILE
    return T.StructType(
        list(schemas.BY_SOURCE[source].fields)
        + [
            T.StructField(schemas.INGESTED_AT, T.TimestampType(), True),
            T.StructField(lineage_name, T.StringType(), True),
        ]
    )


def read_bronze(spark: SparkSession, cfg: PipelineConfig, source: str) -> DataFrame:
    return spark.read.schema(bronze_schema(source)).parquet(cfg.table_path("bronze", source))


def read_bronze_stream(spark: SparkSession, cfg: PipelineConfig, source: str, max_files: int | None = None) -> DataFrame:
    return _file_stream(spark, bronze_schema(source), cfg.table_path("bronze", source), max_files)


def _file_stream(spark: SparkSession, schema: T.StructType, path: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFileAge", files.ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


# Silver tables partitioned on a derived column, so later steps prune by it.
SILVER_PARTITIONS = {"sales": ("sale_month", lambda: F.trunc("sale_date", "month"))}


def _sink(
    df: DataFrame, path: str, checkpoint: str, trigger: dict, name: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    writer = (
        df.writeStream.format("parquet")
        .queryName(name)
        .option("path", path)
        .option("compression", storage.CODEC)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def start_bronze(
    spark: SparkSession, cfg: PipelineConfig, source: str, trigger: dict = AVAILABLE_NOW, max_files: int | None = None
) -> StreamingQuery:
    feed = files.FEEDS[source]
    df = files.read_stream(spark, feed, cfg.landing_path(source), max_files or cfg.max_files_per_trigger)
    df = df.select(*[f.name for f in feed.schema.fields], schemas.INGESTED_AT, schemas.SOURCE_FILE)
    return _sink(df, cfg.table_path("bronze", source), cfg.checkpoint_path(f"bronze_{source}"), trigger, f"bronze_{source}")


def _write_partition(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace the partitions that ``df`` holds, no others."""
    (
        df.hint("rebalance", partition_by[0])  # few files per partition; AQE splits a skewed one
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Rows of a micro-batch as its own partition, replaced if it was there.  They
    come from a scan, which packs small files, and are not shuffled."""
    out = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path, compression=storage.CODEC)


# ------------------------------------------------------------------ checked rows
def checked_schema(source: str) -> T.StructType:
    """Schema of the accepted rows of a feed, as their stream reads them."""
    spec = silver.SPECS[source]
    raw = {f.name: f for f in bronze_schema(source).fields}
    return T.StructType(
        [T.StructField(c, t, True) for c, t in spec.columns]
        + [raw[c] for c in (*spec.passthrough, *spec.lineage)]
        + [T.StructField(VALID, T.BooleanType(), True), T.StructField(BATCH, T.LongType(), True)]
    )


def apply_checks(spark: SparkSession, cfg: PipelineConfig, source: str, batch: DataFrame, batch_id: int) -> None:
    """Both verdicts and the rule counters of one micro-batch of Bronze rows.
    Each verdict is a scan of its own: the Bronze files are smaller than the
    typed rows, which are neither cached nor shuffled."""
    spec = silver.SPECS[source]
    _write_batch(silver.rejects(spec, batch, cfg.run_ts), cfg.table_path("quarantine", source), batch_id)
    counters = Observation(f"rules_{source}_{batch_id}")
    typed = silver.prepare(spec, batch).drop(silver.RAW).observe(counters, *quality.counter_columns(spec.rules))
    typed = typed.withColumn(VALID, quality.valid_predicate(spec.rules))
    kept = typed if cfg.dedup_first and spec.key else typed.filter(VALID)
    rows = kept.select(*silver.business_columns(spec), VALID)
    if source == "employees":
        _write_batch(rows.drop(VALID), cfg.table_path("silver", "employee_events"), batch_id)
    else:
        _write_batch(rows, cfg.table_path("checked", source), batch_id)
    counts = [(spec.name, r.name, r.policy, counters.get["rows_in"], counters.get[f"failed_{r.name}"]) for r in spec.rules]
    log = spark.createDataFrame(counts, "source_table string, rule string, policy string, rows_in long, failed long").coalesce(1)
    path = f"{cfg.table_path('ops', 'rule_counters')}/flow=checked_{source}"
    _write_batch(log, path, batch_id)


def start_checked(
    spark: SparkSession, cfg: PipelineConfig, source: str, trigger: dict = AVAILABLE_NOW, max_files: int | None = None
) -> StreamingQuery:
    bronze = read_bronze_stream(spark, cfg, source, max_files or cfg.max_files_per_trigger)
    return (
        bronze.writeStream.queryName(f"checked_{source}")
        .foreachBatch(lambda batch, number: apply_checks(spark, cfg, source, batch, number))
        .option("checkpointLocation", cfg.checkpoint_path(f"checked_{source}"))
        .trigger(**trigger)
        .start()
    )


def stream_rule_counters(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Pass and fail counts of every rule over all micro-batches (J6)."""
    rows = spark.read.parquet(cfg.table_path("ops", "rule_counters"))
    return (
        rows.groupBy("source_table", "rule", "policy")
        .agg(F.sum("rows_in").alias("rows_in"), F.sum("failed").alias("failed"))
        .withColumn("passed", F.col("rows_in") - F.col("failed"))
    )


# ------------------------------------------------------------------------ Silver
def batch_tag(batch_id: int, kind: str = "r") -> str:
    """Partition of a micro-batch's partials; tags sort as their numbers do."""
    return f"{kind}{batch_id:012d}"


def never_seen(spark: SparkSession, cfg: PipelineConfig, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
    """The first arrivals of a micro-batch, one row for each new key; the keys
    are taken down as the batch's own, so a replay finds the same ones new."""
    key = silver.SPECS[name.removesuffix("_replies")].key
    order = [c for c in (schemas.INGESTED_AT, schemas.SOURCE_FILE) if c in rows.columns]
    return seen.first_arrivals(spark, cfg.table_path("ops", f"seen_{name}"), rows, key, order, batch_id)


def apply_silver_batch(spark: SparkSession, cfg: PipelineConfig, source: str, batch: DataFrame, batch_id: int) -> None:
    """One micro-batch of accepted rows: its first arrivals as Silver rows, and
    what Gold adds up."""
    spec = silver.SPECS[source]
    if not cfg.dedup_watermark:
        batch = never_seen(spark, cfg, source, batch, batch_id)
    # in the reference's order the rules come after the first arrival is chosen
    rows = batch.filter(VALID).select(*silver.business_columns(spec))
    rows = rows.withColumn("updated_at", F.lit(cfg.run_ts).cast("timestamp"))
    path, columns = cfg.table_path("silver", source), ()
    if source in SILVER_PARTITIONS:
        column, value = SILVER_PARTITIONS[source]
        rows, columns = rows.withColumn(column, value()), (column,)
    storage.append_run(rows, path, batch_id, *columns)
    # what Gold adds up is read from the run just written: the rows are made once and not cached
    rows = storage.run_rows(spark, path, batch_id, rows.schema)
    for column in columns:
        months = rows.select(column).distinct().withColumn(BATCH, F.lit(batch_id).cast("long"))
        _write_partition(months, cfg.table_path("ops", f"{source}_months"), BATCH)
    for name, (fact, partials) in gold.PARTIAL_LOGS.items():
        if fact == source:
            sums = partials(rows).withColumn("run", F.lit(batch_tag(batch_id)))
            _write_partition(sums, cfg.table_path("ops", name), "run")


def start_silver(
    spark: SparkSession, cfg: PipelineConfig, source: str, trigger: dict = AVAILABLE_NOW, max_files: int | None = None
) -> StreamingQuery:
    schema, files_a_time = checked_schema(source), max_files or cfg.max_files_per_trigger
    rows = _file_stream(spark, schema, cfg.table_path("checked", source), files_a_time).drop(BATCH)
    if cfg.dedup_watermark:
        rows = dedup.keep_first_stream(rows, [silver.SPECS[source].key], cfg.dedup_watermark)
    return (
        rows.writeStream.queryName(f"silver_{source}")
        .foreachBatch(lambda batch, number: apply_silver_batch(spark, cfg, source, batch, number))
        .option("checkpointLocation", cfg.checkpoint_path(f"silver_{source}"))
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def apply_replies_batch(spark: SparkSession, cfg: PipelineConfig, batch: DataFrame, batch_id: int) -> None:
    """Replies of the first arrival of each review in a micro-batch."""
    if not cfg.dedup_watermark:
        batch = never_seen(spark, cfg, "reviews_replies", batch, batch_id)
    out = batch.select("review_id", F.posexplode("replies").alias("reply_pos", "reply"), *silver.REVIEWS.lineage).select(
        "review_id",
        F.col("reply_pos").cast("int").alias("reply_pos"),
        F.col("reply.author").alias("author"),
        F.col("reply.text").alias("text"),
        *silver.REVIEWS.lineage,
        F.lit(cfg.run_ts).cast("timestamp").alias("updated_at"),
    )
    storage.append_run(out, cfg.table_path("silver", "review_replies"), batch_id)


def merge_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Merge the small files that the micro-batches have left in Silver; merges
    made, by table.  Not while its streams run."""
    out = {}
    for source in ("sales", "returns", "reviews", "review_replies"):
        columns = SILVER_PARTITIONS[source][:1] if source in SILVER_PARTITIONS else ()
        out[source] = storage.merge_small(spark, cfg.table_path("silver", source), *columns)
    return out


def start_review_replies(spark: SparkSession, cfg: PipelineConfig, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Replies keep their own first arrival per review (no rule), as a
    separate flow over the Bronze reviews; reviews without a key have none."""
    spec = silver.REVIEWS
    reviews = silver.prepare(spec, read_bronze_stream(spark, cfg, "reviews", cfg.max_files_per_trigger)).drop(silver.RAW)
    reviews = reviews.filter(F.col(spec.key).isNotNull())
    if cfg.dedup_watermark:
        reviews = dedup.keep_first_stream(reviews, [spec.key], cfg.dedup_watermark)
    return (
        reviews.writeStream.queryName("silver_review_replies")
        .foreachBatch(lambda batch, number: apply_replies_batch(spark, cfg, batch, number))
        .option("checkpointLocation", cfg.checkpoint_path("silver_review_replies"))
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


# ------------------------------------------------------------ employee history
def _bucket(cfg: PipelineConfig):
    return F.pmod(F.xxhash64(F.col(employees.KEY)), F.lit(cfg.history_buckets)).cast("int")


#: Patches are folded once they hold this share of the table's rows, or are this many.
PATCH_SHARE, MOST_PATCHES = 0.5, 32
HISTORY_TIEBREAK = ("ingested_at", "source_file")


def _history_path(cfg: PipelineConfig) -> str:
    return cfg.table_path("silver", "employee_history")


def read_employee_events(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return spark.read.parquet(cfg.table_path("silver", "employee_events"))


def _history_schema(spark: SparkSession, cfg: PipelineConfig) -> T.StructType:
    events = read_employee_events(spark, cfg).drop(BATCH).schema
    instant = events[employees.SEQUENCE].dataType
    ends = [T.StructField(c, instant) for c in (scd2.START_AT, scd2.END_AT)]
    columns = (*employees.HISTORY_COLUMNS, *HISTORY_TIEBREAK)
    return T.StructType([events[c] for c in columns] + ends + [T.StructField(BUCKET, T.IntegerType())])


def _history_as_of(spark: SparkSession, cfg: PipelineConfig, batch_id: int | None = None) -> DataFrame:
    """The stored history, tiebreak columns included, as of a micro-batch."""
    path, schema = _history_path(cfg), _history_schema(spark, cfg)
    tags = storage.live_runs(storage.published_runs(spark, path))
    tags = [t for t in tags if batch_id is None or int(t[1:]) <= batch_id]
    if not tags:
        return spark.createDataFrame([], schema)
    base = storage.read_runs(spark, path, tags[:1], schema).drop("run")
    if not tags[1:]:
        return base
    return scd2.merge_patches(base, storage.read_runs(spark, path, tags[1:], schema), employees.KEY, "run")


def read_history(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return _history_as_of(spark, cfg).select(*employees.HISTORY_COLUMNS, scd2.START_AT, scd2.END_AT)


def patch_pending_history(spark: SparkSession, cfg: PipelineConfig) -> int:
    """Bring the history up to the accepted events; returns the rows written.

    What the new micro-batches change is found against the history as of the
    last one that is written down as covered, and that is written down after
    the patch: a run that died in between is done again, and its patch, if
    it was published at all, is one of versions that the new one has as well.
    """
    done = latest_done(spark, cfg, "employee_history")
    new = read_employee_events(spark, cfg).filter(F.col(BATCH) > done)
    last = new.agg(F.max(BATCH)).first()[0]
    if last is None:
        return 0
    path, tag = _history_path(cfg), batch_tag(last)
    new = new.drop(BATCH)
    buckets = sorted(r[0] for r in new.select(_bucket(cfg)).distinct().collect())  # one for each bucket
    before = _history_as_of(spark, cfg, done).filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)
    new = new.select(*employees.HISTORY_COLUMNS, *HISTORY_TIEBREAK)
    patch = scd2.patch_history(before, new, employees.KEY, employees.SEQUENCE, employees.HISTORY_COLUMNS, HISTORY_TIEBREAK)
    storage.publish_run(patch.withColumn(BUCKET, _bucket(cfg)).hint("rebalance", BUCKET), path, tag, BUCKET)
    mark_done(spark, cfg, "employee_history", last)
    written = storage.read_runs(spark, path, [tag], _history_schema(spark, cfg)).count()
    fold_history(spark, cfg, last)
    return written


def fold_history(spark: SparkSession, cfg: PipelineConfig, batch_id: int) -> bool:
    """Make the history as of a covered micro-batch a compaction, if its patches
    have grown large or many (or ``cfg.full_refresh`` asks for it)."""
    path = _history_path(cfg)
    tags = storage.live_runs(storage.published_runs(spark, path))
    if len(tags) < 2:
        return False
    schema = _history_schema(spark, cfg)
    rows = [storage.read_runs(spark, path, part, schema).count() for part in (tags[:1], tags[1:])]
    if rows[1] <= PATCH_SHARE * rows[0] and len(tags) <= MOST_PATCHES and not cfg.full_refresh:
        return False
    whole = _history_as_of(spark, cfg, batch_id).hint("rebalance", BUCKET)
    storage.publish_run(whole, path, batch_tag(batch_id, "c"), BUCKET)
    return True


def _done_path(cfg: PipelineConfig, step: str) -> str:
    return cfg.table_path("ops", f"{step}_done")


def latest_done(spark: SparkSession, cfg: PipelineConfig, step: str) -> int:
    """Number of the last micro-batch that a derived table covers; -1 for none."""
    if not storage.readable(spark, _done_path(cfg, step)):
        return -1
    return spark.read.schema("batch_id long").parquet(_done_path(cfg, step)).agg(F.max(BATCH)).first()[0]


def mark_done(spark: SparkSession, cfg: PipelineConfig, step: str, batch_id: int) -> None:
    spark.createDataFrame([(batch_id,)], "batch_id long").coalesce(1).write.mode("append").parquet(_done_path(cfg, step))


def run_streams(queries: list[StreamingQuery]) -> dict[str, list[dict]]:
    """Wait until every availableNow query has worked off what has arrived,
    however long that takes; return the progress reports that Spark still has of
    each.  If one fails, the others are stopped before its error is raised, so a
    retry meets no live checkpoint."""
    try:
        for q in queries:
            q.awaitTermination()  # raises the query's error
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    return {q.name: list(q.recentProgress or []) for q in queries}


def stamp(now: dt.datetime | None = None) -> dt.datetime:
    return (now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
