import datetime as dt
import random

import pytest

from medalla.operators import dedup
from medalla.plans import silver

from .test_quality import row, sales_rows

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_valid_later_copy_survives(spark):
    df = sales_rows(spark, [row(amount="-1", at=T1), row(amount="50", at=T2)])
    out = silver.clean(silver.SALES, df).collect()
    assert [float(r["amount"]) for r in out] == [50.0]


def test_dedup_first_restores_reference_order(spark):
    df = sales_rows(spark, [row(amount="-1", at=T1), row(amount="50", at=T2)])
    assert silver.clean(silver.SALES, df, dedup_first=True).count() == 0


def test_first_by_ingestion_then_file(spark):
    df = sales_rows(spark, [row(amount="7", at=T2, f="a.csv"), row(amount="8", at=T1, f="z.csv"), row(amount="9", at=T1, f="b.csv")])
    out = silver.clean(silver.SALES, df).collect()
    assert [float(r["amount"]) for r in out] == [9.0]


def test_null_keys_are_rejected_not_merged(spark):
    df = sales_rows(spark, [row(sale_id=None), row(sale_id=None, amount="3")])
    assert silver.clean(silver.SALES, df).count() == 0
    assert silver.rejects(silver.SALES, df).count() == 2


def test_result_independent_of_row_order(spark):
    rows = [row(sale_id=str(i % 7), amount=str(i + 1), at=dt.datetime(2024, 1, 1 + i % 5), f=f"{i % 3}.csv") for i in range(60)]
    a = sorted(map(tuple, silver.clean(silver.SALES, sales_rows(spark, rows)).collect()))
    random.Random(3).shuffle(rows)
    b = sorted(map(tuple, silver.clean(silver.SALES, sales_rows(spark, rows).repartition(5)).collect()))
    assert a == b


def test_hot_key_is_combined_map_side(spark):
    # one key holds most rows: the plan must pre-aggregate before the shuffle
    df = spark.range(0, 20000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 0 END AS k", "id AS v")
    out = dedup.keep_first(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    got = {r["k"]: r["v"] for r in out.collect()}
    assert got[0] == 0 and len(got) == 1 + 20000 // 3


def _arrive(spark, path, rows, batch_id):
    from medalla.operators import seen

    df = spark.createDataFrame(rows, "k string, v long, note string")
    return sorted(map(tuple, seen.first_arrivals(spark, path, df, "k", ["v"], batch_id).collect()), key=repr)


@pytest.mark.parametrize("least, most", [(6, 30), (20, 30), (2, 2)])
def test_first_arrivals_over_batches(spark, tmp_path, monkeypatch, least, most):
    """New keys, copies within and across batches, NULL keys, replays, folded runs
    and bitmaps that grow or are full: always those of plain Python."""
    from medalla.operators import seen

    monkeypatch.setattr(seen, "LEAST_BITS", least)
    monkeypatch.setattr(seen, "MOST_BITS", most)
    monkeypatch.setattr(seen, "MOST_RUNS", 2)
    rnd, path, taken = random.Random(least), str(tmp_path / "seen"), set()
    for number in range(6):
        rows = [(rnd.choice([None, "hot", f"k{rnd.randint(0, 60)}"]), rnd.randint(0, 99), f"n{number}") for _ in range(80)]
        first = {}
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            first.setdefault(r[0], r)
        want = sorted((r for k, r in first.items() if k not in taken), key=repr)
        assert _arrive(spark, path, rows, number) == want
        if number % 2:
            assert _arrive(spark, path, rows, number) == want  # the batch is run again
        taken |= set(first)


def test_first_arrivals_need_no_python_and_no_state(spark, tmp_path):
    from medalla.operators import seen

    path = str(tmp_path / "seen")
    df = spark.range(1000).selectExpr("CAST(id % 300 AS STRING) AS k", "id AS v")
    seen.first_arrivals(spark, path, df.limit(10), "k", ["v"], 0)
    out = seen.first_arrivals(spark, path, df, "k", ["v"], 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "MapInArrow", "StateStore")) and out.count() == 290


def test_stream_dedup_with_watermark_bounds_state(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame(
        [("a", 1, dt.datetime(2024, 1, 1)), ("a", 2, dt.datetime(2024, 1, 1, 0, 5)), ("b", 3, dt.datetime(2024, 1, 2))],
        "k string, v long, ingested_at timestamp",
    ).write.parquet(str(src))
    stream = spark.readStream.schema("k string, v long, ingested_at timestamp").parquet(str(src))
    q = (
        dedup.keep_first_stream(stream, ["k"], watermark="1 hour")
        .writeStream.format("memory")
        .queryName("dedup_wm")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.table("dedup_wm").collect()) == ["a", "b"]
    q.stop()


def test_rows_of_a_batch_are_joined_only_if_some_keys_were_taken(spark, tmp_path):
    from medalla.operators import seen

    path = str(tmp_path / "seen")
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    plan = lambda rows, n: seen.first_arrivals(spark, path, rows, "k", ["v"], n)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(df.limit(100), 0) and "Join" not in plan(df.filter("v >= 500"), 1)
    some = plan(df, 2)  # dropped below the grouping
    assert some.index("Aggregate") < some.index("Join")


@pytest.mark.parametrize("share, few", [(100, 100_000), (100, 1), (0, 1)])
def test_first_arrivals_by_bitmap_and_by_join(spark, tmp_path, monkeypatch, share, few):
    """Batches small and large beside the keys taken, few and many copies."""
    from medalla.operators import seen

    monkeypatch.setattr(seen, "LARGE_SHARE", share)
    monkeypatch.setattr(seen, "FEW_KEYS", few)
    monkeypatch.setattr(seen, "LEAST_BITS", 6)
    rnd, path, taken = random.Random(few), str(tmp_path / "seen"), set()
    for number in range(3):
        # the second batch has new keys only, some of them copied
        name = "n" if number == 1 else "k"
        rows = [(rnd.choice([f"{name}{number}", None if number else "a", f"{name}{rnd.randint(0, 90)}"]), rnd.randint(0, 99), f"n{number}") for _ in range(90)]
        first = {}
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            first.setdefault(r[0], r)
        want = sorted((r for k, r in first.items() if k not in taken), key=repr)
        assert _arrive(spark, path, rows, number) == want
        assert _arrive(spark, path, rows, number) == want  # the batch is run again
        taken |= set(first)


def test_rows_without_copies_are_not_shuffled(spark, tmp_path):
    from medalla.operators import seen

    path = str(tmp_path / "seen")
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString()
    out = seen.first_arrivals(spark, path, df, "k", ["v"], 0)
    assert "Aggregate" not in plan(out) and out.count() == 1000
    more = df.selectExpr("k || 'x' AS k", "v").unionByName(spark.sql("SELECT '7x' AS k, -1L AS v"))
    out = seen.first_arrivals(spark, path, more, "k", ["v"], 1)
    assert "LeftAnti" in plan(out) and "Union" in plan(out)
    assert out.count() == 1000 and [r["v"] for r in out.filter("k = '7x'").collect()] == [-1]


def test_a_bitmap_has_room_for_its_keys_at_once(spark, tmp_path, monkeypatch):
    from medalla.operators import seen

    monkeypatch.setattr(seen, "LEAST_BITS", 6)
    path = str(tmp_path / "seen")
    df = spark.range(3000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    seen.first_arrivals(spark, path, df.filter("v < 1000"), "k", ["v"], 0)
    assert seen.sizes(spark, path, 1) == [14]  # 8 bits a key or more
    seen.first_arrivals(spark, path, df.filter("v < 1010"), "k", ["v"], 1)
    seen.first_arrivals(spark, path, df, "k", ["v"], 2)
    assert seen.sizes(spark, path, 3) == [14, 18]
    assert seen.first_arrivals(spark, path, df.limit(100), "k", ["v"], 3).isEmpty()
