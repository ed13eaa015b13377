import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from medalla.operators import scd2, sequence
from medalla.plans import employees


def _lead_reference(df, key, seq):
    w = Window.partitionBy(key).orderBy(seq)
    return df.withColumn("nxt", F.lead(seq).over(w))


def test_next_in_sequence_equals_window_lead_under_skew(spark, monkeypatch):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 40)}"
        rows.append((k, i * 10 + rnd.randint(0, 5), f"v{i}"))
    df = spark.createDataFrame(rows, "k string, s long, v string").dropDuplicates(["k", "s"])
    exp = sorted(map(tuple, _lead_reference(df, "k", "s").select("k", "s", "v", "nxt").collect()))
    for per_slice in (1, 50, 10**9):  # a row a slice, several slices a key, one slice
        monkeypatch.setattr(sequence, "NUMBERS_PER_SLICE", per_slice)
        got = sequence.next_in_sequence(df, "k", "s", "nxt")
        assert sorted(map(tuple, got.collect())) == exp


def test_next_in_sequence_few_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, s long")
    got = {(r.k, r.s): r.nxt for r in sequence.next_in_sequence(df, "k", "s", "nxt").collect()}
    assert got == {("a", 1): 2, ("a", 2): None, ("b", 1): None}


def test_next_in_sequence_is_lazy_and_jvm_only(spark):
    df = spark.range(0, 1000).selectExpr("CAST(id % 5 AS STRING) AS k", "id AS s")
    plan = sequence.next_in_sequence(df, "k", "s", "nxt")._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 1000" in plan  # nothing was run or cut off beforehand
    assert not any(x in plan for x in ("MapInArrow", "MapInPandas", "Python", "ExistingRDD"))


def test_next_in_sequence_over_days(spark):
    stamps = [dt.datetime(2024, 1, 1, h) for h in (1, 5, 9)] + [dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)]
    df = spark.createDataFrame([("a", s) for s in stamps] + [("b", stamps[1])], "k string, s timestamp")
    got = {(r.k, r.s): r.nxt for r in sequence.next_in_sequence(df, "k", "s", "nxt").collect()}
    assert got == {("a", s): n for s, n in zip(stamps, [*stamps[1:], None])} | {("b", stamps[1]): None}


EMP = "employee_id string, full_name string, national_id string, email string, salary decimal(12,2), branch_id string, job_title string, event_kind string, event_at timestamp, ingested_at timestamp, source_file string"


def ev(eid, t, kind="Alta", salary="10.00", at=dt.datetime(2024, 1, 1), f="e.csv"):
    from decimal import Decimal

    return (eid, "n", "d", "m", Decimal(salary), "S1", "c", kind, t, at, f)


def t(d):
    return dt.datetime(2024, 1, d)


def _hist(spark, rows):
    return employees.history(spark.createDataFrame(rows, EMP))


def test_late_event_splits_interval(spark):
    h = _hist(spark, [ev("E1", t(1)), ev("E1", t(3)), ev("E1", t(2))]).orderBy("__START_AT").collect()
    assert [(r["__START_AT"], r["__END_AT"]) for r in h] == [(t(1), t(2)), (t(2), t(3)), (t(3), None)]


def test_tie_latest_ingested_wins(spark):
    rows = [ev("E1", t(1), salary="1.00", at=t(5)), ev("E1", t(1), salary="2.00", at=t(6))]
    h = _hist(spark, rows).collect()
    assert len(h) == 1 and float(h[0]["salary"]) == 2.0


def test_replay_is_harmless(spark):
    rows = [ev("E1", t(1)), ev("E1", t(2), kind="Baja")]
    once = sorted(map(tuple, _hist(spark, rows).collect()))
    twice = sorted(map(tuple, _hist(spark, rows + rows).collect()))
    assert once == twice


def test_termination_stays_open_but_not_current(spark):
    h = _hist(spark, [ev("E1", t(1)), ev("E1", t(2), kind="Baja"), ev("E2", t(1))])
    open_rows = h.filter(F.col(scd2.END_AT).isNull()).count()
    cur = [r["employee_id"] for r in employees.current(h).collect()]
    assert open_rows == 2 and cur == ["E2"]


def test_history_intervals_are_contiguous_disjoint_one_open(spark):
    from medalla.plans.catalog import _history

    from .conftest import SF_SMOKE

    h = _history(spark, SF_SMOKE)
    w = Window.partitionBy("employee_id").orderBy("__START_AT")
    chk = h.withColumn("prev_end", F.lag("__END_AT").over(w)).withColumn("rn", F.row_number().over(w))
    assert chk.filter((F.col("rn") > 1) & (F.col("prev_end") != F.col("__START_AT"))).count() == 0
    per_key_open = h.groupBy("employee_id").agg(F.count_if(F.col("__END_AT").isNull()).alias("o"))
    assert per_key_open.filter("o != 1").count() == 0


def test_replayed_micro_batch_changes_nothing(spark):
    from medalla.plans import connectors
    from medalla.sources import adapters
    from medalla.streaming import flows

    from .conftest import SF_SMOKE

    cfg = connectors.scratch_config(spark, "t-replay")
    bronze = adapters.employees(spark, SF_SMOKE)
    flows.apply_checks(spark, cfg, "employees", bronze, 0)
    assert flows.patch_pending_history(spark, cfg) > 1
    assert flows.patch_pending_history(spark, cfg) == 0
    hist1 = sorted(map(tuple, flows.read_history(spark, cfg).collect()), key=repr)
    q1 = spark.read.parquet(cfg.table_path("quarantine", "employees")).count()
    counters = sorted(map(tuple, flows.stream_rule_counters(spark, cfg).collect()))
    flows.apply_checks(spark, cfg, "employees", bronze, 0)  # the same batch again
    assert sorted(map(tuple, flows.stream_rule_counters(spark, cfg).collect())) == counters
    assert sorted(map(tuple, flows.read_history(spark, cfg).collect()), key=repr) == hist1
    assert spark.read.parquet(cfg.table_path("quarantine", "employees")).count() == q1
    assert spark.read.parquet(cfg.table_path("silver", "employee_events")).count() == bronze.count() - q1


# --- hot slices, patches, unchanged versions ------------------------------------


def _hot_day(spark, n=60_000):
    """A third of the rows are one key's, all on one day."""
    hot = F.col("id") % 3 == 0
    second = F.when(hot, F.col("id") % 86_400).otherwise(F.col("id") * 500)
    at = F.timestamp_seconds(F.lit(1_700_006_400) + second).alias("s")
    key = F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k")
    return spark.range(n).select(key, at).dropDuplicates(["k", "s"])


def test_a_key_with_all_its_rows_in_one_day_is_split(spark, monkeypatch):
    monkeypatch.setattr(sequence, "LEAST_SAMPLE", 8)
    df = _hot_day(spark)
    got = sorted(map(tuple, sequence.next_in_sequence(df, "k", "s", "nxt").collect()), key=repr)
    assert got == sorted(map(tuple, _lead_reference(df, "k", "s").collect()), key=repr)
    groups = sequence.sliced_rows(df, "k", "s").groupBy("k", sequence.SLICE, sequence.PART).count()
    hot = [r["count"] for r in groups.filter("k = 'hot'").collect()]
    assert len(hot) > 50 and max(hot) < df.filter("k = 'hot'").count() / 20


def _split(rows, cuts):
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]


def test_patches_equal_a_rebuild(spark):
    """Late, equal, replayed and corrected events, in random order."""
    rnd = random.Random(11)
    rows = [
        ev(f"E{rnd.randint(1, 5)}", t(rnd.randint(1, 28)), kind=rnd.choice(["Alta", "Baja"]), salary=f"{rnd.randint(1, 3)}.00", at=t(rnd.randint(1, 28)))
        for _ in range(120)
    ]
    rows += rnd.sample(rows, 30)
    cols = [*employees.HISTORY_COLUMNS, "ingested_at", "source_file"]
    stored = spark.createDataFrame([], EMP).select(*cols, F.lit(None).cast("timestamp").alias(scd2.START_AT), F.lit(None).cast("timestamp").alias(scd2.END_AT))
    for part in _split(rows, [40, 41, 90]):
        new = spark.createDataFrame(part, EMP)
        patch = scd2.patch_history(stored, new, "employee_id", "event_at", employees.HISTORY_COLUMNS).withColumn("run", F.lit("r1"))
        patch = spark.createDataFrame(patch.collect(), patch.schema)
        stored = scd2.merge_patches(stored, patch, "employee_id", "run")
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        again = scd2.patch_history(stored, new, "employee_id", "event_at", employees.HISTORY_COLUMNS)
        assert again.count() == 0  # a replay changes nothing
    got = stored.select(*employees.HISTORY_COLUMNS, scd2.START_AT, scd2.END_AT)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, _hist(spark, rows).collect()), key=repr)


def test_patch_rows_grow_with_the_events_not_the_history(spark):
    from medalla.plans import connectors
    from medalla.sources import storage
    from medalla.streaming import flows

    cfg = connectors.scratch_config(spark, "t-patch")
    log = spark.range(4000).select(F.concat(F.lit("E"), F.col("id") % 40).alias("employee_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("event_at"))
    rest = {f: F.lit("x") for f in ("full_name", "national_id", "email", "branch_id", "job_title", "event_kind", "source_file")}
    log = log.withColumns({**rest, "salary": F.lit("10.00").cast("decimal(12,2)"), "ingested_at": F.col("event_at")})
    log = log.select(*employees.HISTORY_COLUMNS, "ingested_at", "source_file")

    def arrive(rows, number):
        out = rows.withColumn(flows.BATCH, F.lit(number).cast("long"))
        flows._write_partition(out, cfg.table_path("silver", "employee_events"), flows.BATCH)
        return flows.patch_pending_history(spark, cfg)

    late = F.col("event_at") == F.timestamp_seconds(F.lit(1_700_000_000 + 60 * 1777))
    assert arrive(log.filter(~late), 0) == 3999
    assert arrive(log.filter(late), 1) == 2  # its own version, and the one it cuts short
    assert arrive(log.filter(late), 2) == 0
    # a run that died after its patch: done again together with what came since
    tags = storage.published_runs(spark, cfg.table_path("silver", "employee_history"))
    extra = log.limit(50).withColumn("event_at", F.col("event_at") + F.expr("interval 7 seconds"))
    out = extra.withColumn(flows.BATCH, F.lit(3).cast("long"))
    flows._write_partition(out, cfg.table_path("silver", "employee_events"), flows.BATCH)
    before = flows.latest_done(spark, cfg, "employee_history")
    real, flows.mark_done = flows.mark_done, lambda *a: (_ for _ in ()).throw(RuntimeError("died"))
    try:
        flows.patch_pending_history(spark, cfg)
    except RuntimeError:
        pass
    finally:
        flows.mark_done = real
    assert flows.latest_done(spark, cfg, "employee_history") == before
    assert len(storage.published_runs(spark, cfg.table_path("silver", "employee_history"))) > len(tags)
    more = log.limit(5).withColumn("event_at", F.col("event_at") + F.expr("interval 9 seconds"))
    arrive(more, 4)
    whole = employees.history(log.unionByName(extra).unionByName(more))
    same = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert same(flows.read_history(spark, cfg)) == same(whole)
    # folding changes nothing but the files
    assert flows.fold_history(spark, cfg.with_options(full_refresh=True), 4)
    assert same(flows.read_history(spark, cfg)) == same(whole)
    assert storage.live_runs(storage.published_runs(spark, cfg.table_path("silver", "employee_history"))) == ["c000000000004"]


def test_unchanged_versions_collapse(spark):
    salaries = ["1", "1", "2", "2", "2", "1", "3"]
    rows = [ev("E1", t(i + 1), salary=s) for i, s in enumerate(salaries)] + [ev("E2", t(1)), ev("E2", t(9))]
    h = scd2.collapse_unchanged(_hist(spark, rows), "employee_id", ["salary", "branch_id"])
    got = {(r["employee_id"], int(r["salary"]), r["__START_AT"], r["__END_AT"]) for r in h.collect()}
    assert got == {("E1", 1, t(1), t(3)), ("E1", 2, t(3), t(6)), ("E1", 1, t(6), t(7)), ("E1", 3, t(7), None), ("E2", 10, t(1), None)}
