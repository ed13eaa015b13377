import glob
import json
import uuid

from pyspark.sql import functions as F

from medalla.sources import files, jdbc


def test_jdbc_read_is_partitioned_and_pushes_filters(spark):
    url = f"jdbc:derby:memory:t_{uuid.uuid4().hex[:8]};create=true"
    src = spark.range(0, 1000).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("tracking_id"), F.col("id").alias("order_id")
    )
    jdbc.write_table(src, url, "TRK")
    raw = jdbc.read_table(spark, url, "TRK", partition_column="order_id", lower_bound=0, upper_bound=1000, num_partitions=4)
    assert raw.rdd.getNumPartitions() == 4
    filtered = raw.filter(F.col("order_id") >= 900)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(order_id), *GreaterThanOrEqual(order_id,900)]" in plan
    assert filtered.count() == 100


def test_json_array_files_hold_one_bounded_array_each(spark, tmp_path):
    df = spark.range(0, 2500).select(F.col("id").cast("string").alias("review_id"), F.lit(None).cast("string").alias("x"))
    out = str(tmp_path / "arr")
    files.write_json_arrays(df, out, rows_per_file=1000)
    paths = [p for p in glob.glob(f"{out}/**/part-*", recursive=True)]
    sizes = []
    for p in paths:
        text = open(p).read().strip()
        if text:
            arr = json.loads(text)  # exactly one JSON document per file
            sizes.append(len(arr))
            assert "x" in arr[0]  # NULL fields kept
    assert sum(sizes) == 2500 and len(sizes) == 3 and max(sizes) < 1300


def test_text_key_is_read_in_ranges_that_meet_every_row_once(spark):
    url = f"jdbc:derby:memory:t_{uuid.uuid4().hex[:8]};create=true"
    key = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 7 == 0, F.concat(F.lit("o'b"), F.col("id"))).otherwise(F.concat(F.lit("T"), F.col("id")))
    jdbc.write_table(spark.range(3000).select(key.alias("k"), F.col("id").alias("v")), url, "KEYED", {"createTableColumnTypes": "k VARCHAR(20)"})
    out = jdbc.read_table(spark, url, "KEYED", partition_column='"k"', num_partitions=8)
    assert 8 <= out.rdd.getNumPartitions() <= 9  # one of them for the NULLs
    assert sorted(r["v"] for r in out.collect()) == list(range(3000))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 3000 / 8
    assert jdbc.quoted(spark, url, "k") == '"k"'
    # an empty table, and one key only
    jdbc.write_table(spark.range(0).select(F.col("id").cast("string").alias("k")), url, "NO_ROWS", {"createTableColumnTypes": "k VARCHAR(20)"})
    assert jdbc.read_table(spark, url, "NO_ROWS", partition_column='"k"').count() == 0
    jdbc.write_table(spark.range(40).select(F.lit("same").alias("k")), url, "ONE_KEY", {"createTableColumnTypes": "k VARCHAR(20)"})
    assert jdbc.read_table(spark, url, "ONE_KEY", partition_column='"k"', num_partitions=4).count() == 40


def test_one_view_shows_each_reader_what_the_groups_allow(spark):
    from medalla.functions.labels import REDACTED
    from medalla.plans import governance

    staff = governance.tag_pii(spark.createDataFrame([("E1", "D1", "a@x")], "employee_id string, national_id string, email string"))
    spark.createDataFrame([("ana", "hr"), ("leo", "sales")], "member string, group_name string").createOrReplaceTempView("t_members")
    spark.sql("DECLARE OR REPLACE VARIABLE t_reader STRING DEFAULT 'ana'")
    governance.create_masked_view(spark, staff, "t_staff", "t_members", "hr", "t_reader")
    read = lambda: tuple(spark.table("t_staff").first())
    assert read() == ("E1", "D1", "a@x")
    spark.sql("SET VAR t_reader = 'leo'")
    assert read() == ("E1", REDACTED, REDACTED)
    spark.sql("SET VAR t_reader = NULL")
    assert read() == ("E1", REDACTED, REDACTED)


def test_files_under_names_of_their_own(spark, tmp_path):
    df = spark.range(20).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    files.write_named_csv(df, str(tmp_path), F.concat(F.lit("day-"), F.col("b")))
    assert sorted(p.name for p in tmp_path.glob("*.csv")) == ["day-0.csv", "day-1.csv", "day-2.csv"]
    assert spark.read.option("header", True).csv(str(tmp_path)).count() == 20


def test_null_texts_are_written_to_declared_columns(spark):
    url = f"jdbc:derby:memory:t_{uuid.uuid4().hex[:8]};create=true"
    rows = [(a, b, i) for i, (a, b) in enumerate([("x", "y"), (None, "y"), ("x", None), (None, None)])]
    df = spark.createDataFrame(rows, "a string, b string, v int")
    jdbc.write_table(df, url, "PARTLY", {"createTableColumnTypes": "a VARCHAR(9), b VARCHAR(9)"})
    assert sorted(map(tuple, jdbc.read_table(spark, url, "PARTLY").collect()), key=lambda r: r[2]) == rows


def test_large_files_under_names_of_their_own_are_dealt(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") < 1900, "x").otherwise("y").alias("b"))
    files.write_named_csv(df, str(tmp_path), F.col("b"), rows_per_file=500)
    found = sorted(p.relative_to(tmp_path) for p in tmp_path.glob("part=*/*.csv"))
    assert {p.name for p in found} == {"x.csv", "y.csv"} and len({p.parent for p in found}) == 4
    assert max(len((tmp_path / p).read_text().splitlines()) for p in found) < 700
    back = spark.read.option("header", True).schema("a string, b string").csv(str(tmp_path)).select("a", "b", F.col("_metadata.file_name").alias("f"))
    assert sorted(int(r["a"]) for r in back.collect()) == list(range(2000)) and back.filter("f <> b || '.csv'").isEmpty()


def test_gzip_drops_are_written_at_the_fastest_level(spark, tmp_path):
    import gzip

    df = spark.range(20_000).selectExpr("CONCAT('T', id) AS a", "CAST(id * 7919 % 997 AS STRING) AS b").coalesce(1)
    files.write_csv(df, str(tmp_path / "d"), compression="gzip")
    (path,) = glob.glob(f"{tmp_path}/d/*.csv.gz")
    packed = open(path, "rb").read()
    assert len(packed) > 1.05 * len(gzip.compress(gzip.decompress(packed), 6))
    assert spark.read.option("header", True).csv(str(tmp_path / "d")).exceptAll(df).isEmpty()
