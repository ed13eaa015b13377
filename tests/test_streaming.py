from pyspark.sql import Window
from pyspark.sql import functions as F

from medalla import flows as run
from medalla.plans import catalog, connectors, silver
from medalla.sources import adapters, files, storage
from medalla.streaming import flows

from .conftest import SF_SMOKE

SALES_COLS = [f for f in adapters.schemas.BY_SOURCE["sales"].fieldNames()]


def _land(cfg, rows, drop, source="sales"):
    """Rows as a CSV drop under the upstream names."""
    files.write_csv(connectors._raw(rows, source), f"{cfg.landing_path(source)}/drop={drop}")


def _read(spark, cfg, layer, name):
    return run.read_table(spark, cfg, layer, name)


def _business(df, spec):
    return sorted(map(tuple, df.select(*[c for c, _ in spec.columns]).collect()))


def test_rerun_adds_nothing_and_new_drop_only_its_rows(spark):
    cfg = connectors.scratch_config(spark, "t-rerun")
    sales = adapters.sales(spark, SF_SMOKE).select(*SALES_COLS)
    half = F.abs(F.xxhash64(*SALES_COLS)) % 2
    _land(cfg, sales.filter(half == 0), 0)
    bronze = cfg.table_path("bronze", "sales")
    flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
    first = spark.read.parquet(bronze).count()
    flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
    assert spark.read.parquet(bronze).count() == first
    _land(cfg, sales.filter(half == 1), 1)
    flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
    assert spark.read.parquet(bronze).count() == sales.count()
    assert spark.read.parquet(bronze).select("source_file").distinct().count() >= 2


def test_sales_stream_equals_batch_when_copies_arrive_in_order(spark):
    """The n-th copy of every key (in the batch dedup order) arrives in drop n."""
    cfg = connectors.scratch_config(spark, "t-stream-batch")
    bronze = adapters.sales(spark, SF_SMOKE)
    order = ["ingested_at", "source_file"] + [c for c, _ in silver.SALES.columns if c != "sale_id"]
    w = Window.partitionBy("sale_id").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    # rank on the raw rows using the same typed ordering expressions
    typed = silver.prepare(silver.SALES, bronze)
    raw_rank = typed.withColumn("_rank", F.row_number().over(w)).select(*[f"{silver.RAW}.{c}" for c in SALES_COLS], "_rank")
    n = raw_rank.agg(F.max("_rank")).first()[0]
    for r in range(1, n + 1):
        _land(cfg, raw_rank.filter(F.col("_rank") == r).drop("_rank"), r)
        flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
        flows.run_streams([flows.start_checked(spark, cfg, "sales")])
        flows.run_streams([flows.start_silver(spark, cfg, "sales")])
    streamed = storage.read(spark, cfg.table_path("silver", "sales"))
    assert _business(streamed, silver.SALES) == _business(silver.clean(silver.SALES, bronze), silver.SALES)


def test_run_once_end_to_end(spark):
    cfg = connectors.scratch_config(spark, "t-run")
    connectors.stage_landing(spark, cfg, SF_SMOKE)
    tracking = lambda s: connectors._raw(adapters.tracking(s, SF_SMOKE), "tracking")
    summary = run.run_once(spark, cfg, tracking_reader=tracking)
    assert set(summary["gold_row_counts"]) == {
        "sales_by_branch_month",
        "product_sales_returns",
        "headcount_by_branch",
        "negative_review_rate",
    }
    assert all(v > 0 for v in summary["gold_row_counts"].values())
    # deterministic marts equal the batch queries
    got = _read(spark, cfg, "gold", "headcount_by_branch")
    assert sorted(map(tuple, catalog.portable(got).collect())) == sorted(
        map(tuple, catalog.headcount_by_branch(spark, SF_SMOKE).collect())
    )
    got = _read(spark, cfg, "gold", "negative_review_rate")
    assert sorted(map(tuple, catalog.portable(got).collect())) == sorted(
        map(tuple, catalog.negative_review_rate(spark, SF_SMOKE).collect())
    )
    q = run.read_quarantine(spark, cfg)
    assert q.count() == catalog.quarantine_rows(spark, SF_SMOKE).count() == summary["quarantine_total"]
    log = spark.read.parquet(cfg.table_path("ops", "run_log"))
    assert log.filter("event_type = 'rule_counters'").count() >= 3
    # stream counters summed over micro-batches equal the batch rule counters
    import json

    batch = {(r["source_table"], r["rule"]): r["failed"] for r in catalog.rule_counters(spark, SF_SMOKE).collect()}
    for msg in [r["message"] for r in log.filter("event_type = 'rule_counters'").collect()]:
        entry = json.loads(msg)
        for name, m in entry["metrics"].items():
            src = name.removeprefix("rules_")
            for k, v in m.items():
                if k.startswith("failed_"):
                    assert batch[(src, k.removeprefix("failed_"))] == v, (src, k)
    # a second run with no new files adds nothing to the streamed tables or marts
    before = storage.read(spark, cfg.table_path("silver", "sales")).count()
    marts = {n: sorted(map(tuple, _read(spark, cfg, "gold", n).collect()), key=repr)
             for n in ("product_sales_returns", "negative_review_rate")}
    run.run_once(spark, cfg.with_options(run_ts=flows.stamp()), tracking_reader=tracking)
    assert storage.read(spark, cfg.table_path("silver", "sales")).count() == before
    for n, rows in marts.items():
        assert sorted(map(tuple, _read(spark, cfg, "gold", n).collect()), key=repr) == rows


def test_ragged_csv_and_json_types(spark, tmp_path):
    p = tmp_path / "ragged"
    p.mkdir()
    (p / "a.csv").write_text("id,m\n2\n3,4,5\n")
    df = spark.read.schema("id string, m string").option("header", "true").csv(str(p))
    assert sorted(map(tuple, df.collect())) == [("2", None), ("3", "4")]
    j = tmp_path / "rev"
    j.mkdir()
    (j / "r.json").write_text('[{"resena_id":"a","calificacion":"5"},{"resena_id":"b","calificacion":4.5},{"resena_id":"c","calificacion":3}]')
    feed = files.FEEDS["reviews"]
    got = {r["review_id"]: r["rating"] for r in files.read_snapshot(spark, feed, str(j)).collect()}
    assert got == {"a": None, "b": None, "c": 3}


def test_views_and_sql_row_counts(spark):
    from medalla.plans import views

    cfg = connectors.scratch_config(spark, "t-views")
    connectors.stage_landing(spark, cfg, SF_SMOKE)
    run.run_once(spark, cfg)
    names = views.register_views(spark, cfg)
    assert "gold_sales_by_branch_month" in names and "silver_employee_history" in names
    sql_counts = {r["table_name"]: r["rows"] for r in views.gold_row_counts_sql(spark).collect() if r["rows"]}
    stored = {r["table_name"]: r["rows"] for r in _read(spark, cfg, "ops", "gold_row_counts").collect()}
    # tracking is absent in this run, every Gold table is present
    assert {k: v for k, v in stored.items()} == {k: sql_counts[k] for k in stored}
    v = views.masked_staff_view(spark, spark.table("silver_employees_current"), privileged=False)
    assert spark.sql(f"SELECT DISTINCT national_id FROM {v}").first()[0] == "***REDACTADO***"
    assert spark.sql("SELECT DISTINCT email FROM silver_employees_current_masked").first()[0] == "***REDACTADO***"
    views.register_views(spark, cfg.with_options(privileged=True))
    assert spark.sql("SELECT count(*) FROM silver_employees_current_masked WHERE email = '***REDACTADO***'").first()[0] == 0


def test_incremental_monthly_mart_equals_full_recompute(spark):
    from medalla.plans import gold

    cfg = connectors.scratch_config(spark, "t-incr")
    sales = adapters.sales(spark, SF_SMOKE).select(*SALES_COLS)
    # drop 1 holds only the sales of 1998 onwards: the second run touches those months only
    late = F.col("sale_date") >= "1998-01-01"
    _land(cfg, sales.filter(~late | F.col("sale_date").isNull()), 0)
    _land(cfg, adapters.returns(spark, SF_SMOKE), 0, "returns")
    files.write_json_lines(connectors._raw(adapters.products(spark, SF_SMOKE), "products"), cfg.landing_path("products"))
    run.run_once(spark, cfg)
    _land(cfg, sales.filter(late), 1)
    cfg2 = cfg.with_options(run_ts=flows.stamp())
    summary = run.run_once(spark, cfg2)
    assert 0 < summary["gold_months_recomputed"] < 100
    silver_sales = storage.read(spark, cfg.table_path("silver", "sales"))
    got = spark.read.parquet(cfg.table_path("gold", "sales_by_branch_month"))
    full = gold.sales_by_branch_month(silver_sales)
    cols = full.columns
    assert sorted(map(tuple, catalog.portable(got.select(*cols)).collect()), key=repr) == sorted(
        map(tuple, catalog.portable(full).collect()), key=repr
    )
    # per-run partials summed == partials of the whole table
    merged = run.read_partials(spark, cfg.table_path("ops", "sales_by_product"))
    assert merged.select("run").distinct().count() == 2
    a = sorted(map(tuple, catalog.portable(gold.merge_partials(merged)).collect()), key=repr)
    b = sorted(map(tuple, catalog.portable(gold.sales_per_product(silver_sales)).collect()), key=repr)
    assert a == b


def test_new_generation_rebuilds_downstream_from_untouched_bronze(spark):
    cfg = connectors.scratch_config(spark, "t-gen")
    sales = adapters.sales(spark, SF_SMOKE).select(*SALES_COLS)
    _land(cfg, sales, 0)
    run.run_once(spark, cfg)
    bronze_rows = spark.read.parquet(cfg.table_path("bronze", "sales")).count()
    first = storage.read(spark, cfg.table_path("silver", "sales")).count()
    g1 = cfg.with_options(generation="g1", run_ts=flows.stamp())
    run.run_once(spark, g1)
    assert spark.read.parquet(g1.table_path("bronze", "sales")).count() == bronze_rows  # not re-ingested
    assert storage.read(spark, g1.table_path("silver", "sales")).count() == first  # rebuilt from Bronze
    assert g1.table_path("silver", "sales") != cfg.table_path("silver", "sales")


def test_backlog_is_worked_off_in_bounded_batches(spark):
    cfg = connectors.scratch_config(spark, "t-backlog").with_options(max_files_per_trigger=1)
    sales = adapters.sales(spark, SF_SMOKE).select(*SALES_COLS)
    part = F.abs(F.xxhash64(*SALES_COLS)) % 3
    for i in range(3):
        _land(cfg, sales.filter(part == i).coalesce(1), i)
    reports = flows.run_streams([flows.start_bronze(spark, cfg, "sales")])["bronze_sales"]
    assert len([r for r in reports if r.numInputRows > 0]) == 3
    assert spark.read.parquet(cfg.table_path("bronze", "sales")).count() == sales.count()


def test_module_entry_point_runs_from_session_config(spark, capsys):
    import json

    from medalla import __main__ as cli

    cfg = connectors.scratch_config(spark, "t-cli")
    connectors.stage_landing(spark, cfg, SF_SMOKE)
    keys = {"medalla.warehouse": cfg.warehouse, "medalla.landing": cfg.landing, "medalla.checkpoints": cfg.checkpoints}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        cli.main()
    finally:
        for k in keys:
            spark.conf.unset(k)
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["gold_row_counts"]["product_sales_returns"] > 0


def test_partial_logs_compact_without_changing_totals(spark):
    from medalla.plans import gold

    cfg = connectors.scratch_config(spark, "t-compact").with_options(partials_compact_after=1)
    sales = adapters.sales(spark, SF_SMOKE).select(*SALES_COLS)
    files.write_json_lines(connectors._raw(adapters.products(spark, SF_SMOKE), "products"), cfg.landing_path("products"))
    _land(cfg, adapters.returns(spark, SF_SMOKE), 0, "returns")
    part = F.abs(F.xxhash64(*SALES_COLS)) % 3
    path = cfg.table_path("ops", "sales_by_product")
    live_counts = []
    for i in range(3):
        _land(cfg, sales.filter(part == i), i)
        run.run_once(spark, cfg.with_options(run_ts=flows.stamp()))
        live_counts.append(len(run.live_runs(storage.partition_values(spark, path, "run"))))
    assert live_counts == [1, 2, 1]  # two micro-batches, then folded into a compaction
    silver_sales = storage.read(spark, cfg.table_path("silver", "sales"))
    a = sorted(map(tuple, catalog.portable(gold.merge_partials(run.read_partials(spark, path))).collect()), key=repr)
    b = sorted(map(tuple, catalog.portable(gold.sales_per_product(silver_sales)).collect()), key=repr)
    assert a == b


def test_live_runs_ignore_folded_runs():
    tags = ["c20240101T000000000000", "r20240102T000000000000", "c20240103T000000000000", "r20240103T000000000000",
            "r20240104T000000000000"]
    assert run.live_runs(tags) == ["c20240103T000000000000", "r20240104T000000000000"]
    assert run.live_runs(["r1", "r2"]) == ["r1", "r2"]


def test_failed_step_is_logged_and_slow_run_warned(spark):
    import pytest

    cfg = connectors.scratch_config(spark, "t-fail").with_options(run_duration_warn_seconds=0.0)
    files.write_json_lines(connectors._raw(adapters.products(spark, SF_SMOKE), "products"), cfg.landing_path("products"))

    def broken(_spark):
        raise RuntimeError("tracking source down")

    with pytest.raises(RuntimeError):
        run.run_once(spark, cfg, tracking_reader=broken)
    log = spark.read.parquet(cfg.table_path("ops", "run_log"))
    row = log.filter("event_type = 'step_failed'").first()
    assert row["level"] == "ERROR" and "tracking source down" in row["message"]
    run.run_once(spark, cfg.with_options(run_ts=flows.stamp()))
    log = spark.read.parquet(cfg.table_path("ops", "run_log"))
    assert log.filter("event_type = 'run' AND level = 'WARN'").count() == 1


def test_snapshot_versions_survive_crashes(spark, monkeypatch):
    import pytest

    cfg = connectors.scratch_config(spark, "t-publish")
    path = cfg.table_path("gold", "demo")
    assert not storage.readable(spark, path)
    storage.publish(spark.range(0, 5), path)
    reader = storage.read(spark, path)  # planned against the first version
    storage.publish(spark.range(0, 7), path)
    assert storage.read(spark, path).count() == 7 and reader.count() == 5
    # a crash while the next version is written, or before its pointer is
    with pytest.raises(Exception):
        storage.publish(spark.range(0, 9).select(F.raise_error(F.lit("lost"))), path)
    spark.range(0, 3).write.parquet(f"{path}/v=99")
    assert storage.read(spark, path).count() == 7
    storage.publish(spark.range(0, 9), path)
    assert storage.read(spark, path).count() == 9
    assert len(storage.partition_values(spark, path, "v")) == 2


def test_streaming_replies_equal_batch_replies(spark):
    cfg = connectors.scratch_config(spark, "t-replies")
    threaded = connectors._raw(adapters.threaded_reviews(spark, SF_SMOKE), "reviews")
    files.write_json_arrays(threaded, cfg.landing_path("reviews"), rows_per_file=40)
    flows.run_streams([flows.start_bronze(spark, cfg, "reviews")])
    flows.run_streams([flows.start_review_replies(spark, cfg)])
    got = storage.read(spark, cfg.table_path("silver", "review_replies")).select("review_id", "reply_pos", "author", "text")
    exp = catalog.review_replies(spark, SF_SMOKE).select("review_id", "reply_pos", "author", "text")
    assert got.count() > 0
    assert sorted(map(tuple, catalog.portable(got).collect())) == sorted(map(tuple, exp.collect()))


def test_run_log_latest_entries(spark):
    import datetime as dt

    from medalla.plans import monitoring

    cfg = connectors.scratch_config(spark, "t-log")
    log = monitoring.RunLog(spark, cfg.table_path("ops", "run_log"))
    for i in range(5):
        log.add("step", f"m{i}", at=dt.datetime(2024, 1, 1, 0, i))
    log.flush()
    assert [r["message"] for r in log.latest(3).collect()] == ["m4", "m3", "m2"]


def test_late_file_with_an_old_time_is_taken(spark):
    import glob
    import os
    import time

    cfg = connectors.scratch_config(spark, "t-old")
    sales = adapters.sales(spark, SF_SMOKE).filter("sale_id is not null").limit(3)
    for i, row in enumerate(sales.collect()):
        _land(cfg, spark.createDataFrame([row], sales.schema), i)
        if i == 1:
            for f in glob.glob(f"{cfg.landing_path('sales')}/drop=1/*.csv"):
                os.utime(f, (time.time() - 10 * 86400,) * 2)
        flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
    assert _read(spark, cfg, "bronze", "sales").count() == 3


def test_counters_cover_more_batches_than_progress_reports(spark):
    cfg = connectors.scratch_config(spark, "t-counters").with_options(max_files_per_trigger=1)
    sales = adapters.sales(spark, SF_SMOKE).limit(60)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        files.write_csv(connectors._raw(sales, "sales").repartition(12), cfg.landing_path("sales"))
        flows.run_streams([flows.start_bronze(spark, cfg, "sales")])
        flows.run_streams([flows.start_checked(spark, cfg, "sales")])
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(storage.partition_values(spark, f"{cfg.table_path('ops', 'rule_counters')}/flow=checked_sales", "batch_id")) >= 10
    assert {r["rows_in"] for r in flows.stream_rule_counters(spark, cfg).collect()} == {60}


def test_failed_stream_stops_the_others(spark):
    import pytest

    cfg = connectors.scratch_config(spark, "t-stop")
    _land(cfg, adapters.sales(spark, SF_SMOKE), 0)
    _land(cfg, adapters.returns(spark, SF_SMOKE), 0, "returns")
    broken = (
        files.read_stream(spark, files.FEEDS["sales"], cfg.landing_path("sales"))
        .select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
        .writeStream.format("noop")
        .option("checkpointLocation", cfg.checkpoint_path("broken"))
        .trigger(availableNow=True)
        .start()
    )
    other = flows.start_bronze(spark, cfg, "returns")
    with pytest.raises(Exception, match="broken"):
        flows.run_streams([broken, other])
    assert not other.isActive
    flows.run_streams([flows.start_bronze(spark, cfg, "returns")])


def _marts(spark, cfg):
    return {
        n: sorted(map(tuple, catalog.portable(_read(spark, cfg, "gold", n)).collect()), key=repr)
        for n in ("sales_by_branch_month", "product_sales_returns")
    }


def test_a_run_that_died_anywhere_is_made_up_for(spark, monkeypatch):
    """Drop 1 is taken in by a run that dies after each of its steps in turn;
    the next run's marts must be those of all rows."""
    import pytest

    from medalla.plans import gold

    cfg = connectors.scratch_config(spark, "t-died")
    sales = adapters.sales(spark, SF_SMOKE)
    part = F.abs(F.xxhash64(*SALES_COLS)) % 4
    files.write_json_lines(connectors._raw(adapters.products(spark, SF_SMOKE), "products"), cfg.landing_path("products"))
    _land(cfg, adapters.returns(spark, SF_SMOKE), 0, "returns")
    _land(cfg, sales.filter(part == 0), 0)
    run.run_once(spark, cfg)
    dies_in = [("start_silver", flows), ("_monthly_sales", run), ("mark_done", flows)]
    for i, (step, module) in enumerate(dies_in, start=1):
        _land(cfg, sales.filter(part == i), i)
        with monkeypatch.context() as m:
            def die(*a, **k):
                raise RuntimeError("died")

            m.setattr(module, step, die)
            with pytest.raises(RuntimeError):
                run.run_once(spark, cfg.with_options(run_ts=flows.stamp()))
    run.run_once(spark, cfg.with_options(run_ts=flows.stamp()))
    silver_sales = _read(spark, cfg, "silver", "sales")
    assert silver_sales.count() == silver.clean(silver.SALES, sales).count()
    full = gold.sales_by_branch_month(silver_sales)
    got = _marts(spark, cfg)
    cols = _read(spark, cfg, "gold", "sales_by_branch_month").columns
    assert got["sales_by_branch_month"] == sorted(map(tuple, catalog.portable(full.select(*cols)).collect()), key=repr)
    exp = gold.product_sales_returns(
        _read(spark, cfg, "silver", "products"), silver_sales, _read(spark, cfg, "silver", "returns")
    )
    assert got["product_sales_returns"] == sorted(map(tuple, catalog.portable(exp).collect()), key=repr)


def test_reviews_without_a_key_have_no_replies(spark):
    rows = [(None, "p", "c", 5, "x", [], [("a", "t")], "2024-01-01"), ("r", "p", "c", 5, "x", [], [("a", "t"), ("b", None)], "2024-01-01")]
    reviews = spark.createDataFrame(rows, adapters.schemas.REVIEWS)
    bronze = reviews.withColumn("ingested_at", F.current_timestamp()).withColumn("source_file", F.lit("f"))
    got = [(r["review_id"], r["reply_pos"], r["author"], r["text"]) for r in silver.review_replies(bronze).collect()]
    assert sorted(got, key=repr) == [("r", 0, "a", "t"), ("r", 1, "b", None)]
    cfg = connectors.scratch_config(spark, "t-keyless")
    files.write_json_arrays(connectors._raw(reviews, "reviews"), cfg.landing_path("reviews"))
    flows.run_streams([flows.start_bronze(spark, cfg, "reviews")])
    flows.run_streams([flows.start_review_replies(spark, cfg)])
    got = [(r["review_id"], r["reply_pos"], r["author"], r["text"]) for r in _read(spark, cfg, "silver", "review_replies").collect()]
    assert sorted(got, key=repr) == [("r", 0, "a", "t"), ("r", 1, "b", None)]


def test_payload_holds_lineage_and_nulls(spark):
    import json

    bad = adapters.sales(spark, SF_SMOKE).withColumn("amount", F.lit(None).cast("string")).limit(1)
    row = silver.rejects(silver.SALES, bad).first()
    payload = json.loads(row["payload"])
    assert set(payload) == {*SALES_COLS, "ingested_at", "source_file"} and payload["amount"] is None
    assert payload["source_file"] == row["source_file"]


def test_distinct_counts_where_keys_repeat(spark):
    from medalla.plans import gold

    rows = [("s1", "p", "b", 1, 2, "2024-01-05")] * 2 + [("s2", "p", "b", 3, 4, "2024-01-06")]
    sales = spark.createDataFrame(rows, "sale_id string, product_id string, branch_id string, quantity int, amount int, sale_date string")
    sales = sales.withColumn("sale_date", F.to_date("sale_date"))
    assert gold.sales_by_branch_month(sales).first()["sales_count"] == 3
    assert gold.sales_by_branch_month(sales, repeats=True).first()["sales_count"] == 2
    assert gold.sales_per_product(sales, repeats=True).first()["sales_count"] == 2
    reviews = spark.createDataFrame([("r", "p", 1)] * 2 + [("q", "p", 5)], "review_id string, product_id string, rating int")
    assert (lambda r: (r["n"], r["neg"]))(gold.reviews_per_product(reviews, repeats=True).first()) == (2, 1)


def test_files_grow_with_the_logarithm_of_the_batches(spark):
    cfg = connectors.scratch_config(spark, "t-merge")
    path = cfg.table_path("silver", "sales")
    months = F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int"))
    for batch in range(40):
        rows = spark.range(batch * 6, batch * 6 + 6).select(F.col("id").cast("string").alias("sale_id"), months.alias("sale_month"))
        storage.append_run(rows.coalesce(1), path, batch, "sale_month")
        if batch in (7, 20):
            old = storage.read(spark, path)  # a reader that has planned before the merge
            assert storage.merge_small(spark, path, "sale_month") >= 1
            assert old.count() == 6 * (batch + 1)
    storage.merge_small(spark, path, "sale_month")
    tags = storage.appended_runs(storage.published_runs(spark, path))
    assert len(tags) <= 8 and storage.steps_of(tags[0])[0] == 0 and storage.steps_of(tags[-1])[1] == 39
    got = storage.read(spark, path)
    assert sorted(int(r["sale_id"]) for r in got.collect()) == list(range(240)) and got.columns == ["sale_id", "sale_month"]
    assert len(got.inputFiles()) / 2 <= 8  # of either month
    # a batch that is run again after it was merged counts once
    again = spark.range(0, 6).select(F.col("id").cast("string").alias("sale_id"), months.alias("sale_month"))
    storage.append_run(again, path, 0, "sale_month")
    assert storage.read(spark, path).count() == 240


def test_runs_of_an_appended_table():
    r = [f"r{i:012d}" for i in range(9)]
    wide = "m000000000000-000000000007"
    assert storage.appended_runs([*r, wide]) == [wide, r[8]]
    assert storage.small_runs(r[:7]) == [] and storage.small_runs(r[:8]) == r[:8]
    assert storage.small_runs([wide, *r]) == []


def test_a_batch_is_neither_cached_nor_typed_twice_over(spark, monkeypatch):
    cfg = connectors.scratch_config(spark, "t-lean")
    bronze = adapters.sales(spark, SF_SMOKE)

    def cached(*a, **k):
        raise AssertionError("cached")

    monkeypatch.setattr(type(bronze), "persist", cached)
    flows.apply_checks(spark, cfg, "sales", bronze, 0)
    rejected = _read(spark, cfg, "quarantine", "sales").count()
    accepted = spark.read.parquet(cfg.table_path("checked", "sales"))
    assert rejected == silver.rejects(silver.SALES, bronze).count() and rejected + accepted.count() == bronze.count()
    assert {r["rows_in"] for r in flows.stream_rule_counters(spark, cfg).collect()} == {bronze.count()}
    for number in range(2):  # the second time no key is new
        flows.apply_silver_batch(spark, cfg, "sales", accepted.drop(flows.BATCH), number)
    assert _business(storage.read(spark, cfg.table_path("silver", "sales")), silver.SALES) == _business(silver.clean(silver.SALES, bronze), silver.SALES)
    assert storage.published_runs(spark, cfg.table_path("silver", "sales")) == ["r000000000000"]


def test_counters_take_as_many_batches_whatever_the_files(spark, monkeypatch):
    real, started = files.write_csv, []
    monkeypatch.setattr(files, "write_csv", lambda df, path, **k: real(df.repartition(13), path, **k))
    start = flows.start_checked
    monkeypatch.setattr(flows, "start_checked", lambda s, cfg, name, **k: started.append((cfg, name)) or start(s, cfg, name, **k))
    got = connectors.stream_rule_counters(spark, SF_SMOKE)
    assert got.count() == 10
    for cfg, name in started:
        batches = storage.partition_values(spark, f"{cfg.table_path('ops', 'rule_counters')}/flow=checked_{name}", "batch_id")
        assert 1 <= len(batches) <= connectors.MICRO_BATCHES


def test_preferred_copies_are_those_of_the_whole_order(spark):
    spec = silver.SALES
    assert silver.as_sent(spec) == {"sale_id", "product_id", "channel"}
    rows = adapters.sales(spark, SF_SMOKE)
    rows = rows.unionByName(rows.withColumn("amount", F.concat(F.lit(" "), "amount")))  # the same when typed
    valid = silver.prepare(spec, rows).filter("sale_id IS NOT NULL AND amount > 0")
    order = list(spec.lineage) + [c for c, _ in spec.columns if c != spec.key]
    want = valid.groupBy(spec.key).agg(F.min(F.struct(*order, silver.RAW)).alias("p")).select(*[f"p.{silver.RAW}.{c}" for c in spec.raw_columns])
    key = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert key(connectors._preferred(rows, spec)) == key(want)
