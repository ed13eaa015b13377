import datetime as dt


from medalla.operators import quality
from medalla.operators.quality import Rule
from medalla.plans import silver


def sales_rows(spark, rows):
    cols = "sale_id string, branch_id string, product_id string, quantity string, amount string, pay_method string, sale_date string, channel string, ingested_at timestamp, source_file string"
    return spark.createDataFrame(rows, cols)


def row(sale_id="1", amount="10.00", sale_date="2024-01-02", at=dt.datetime(2024, 1, 1), f="a.csv", branch="S1"):
    return (sale_id, branch, "P1", "2", amount, "efv", sale_date, "web", at, f)


def test_amount_parsing_never_fails(spark):
    bad = ["abc", "", None, "0", "-1", "0.004", "99999999999", "1,5"]
    good = {"0.005": 0.01, " 12.5 ": 12.5}
    df = sales_rows(spark, [row(sale_id=str(i), amount=a) for i, a in enumerate(bad + list(good))])
    cls = silver.classified(silver.SALES, df)
    rej = {r["sale_id"] for r in quality.rejected(cls).collect()}
    assert rej == {str(i) for i in range(len(bad))}
    acc = {r["sale_id"]: float(r["amount"]) for r in quality.accepted(cls).collect()}
    assert acc == {str(len(bad)): 0.01, str(len(bad) + 1): 12.5}


def test_bad_date_keeps_sale_with_null_date(spark):
    df = sales_rows(spark, [row(sale_date="31/12/2024"), row(sale_id="2", sale_date="2024-02-30")])
    out = silver.clean(silver.SALES, df).collect()
    assert len(out) == 2 and all(r["sale_date"] is None for r in out)


def test_null_verdict_is_a_failure(spark):
    df = spark.createDataFrame([(None,), (3,)], "x int")
    cls = quality.classify(df, [Rule("x_pos", "x > 0")])
    assert sorted((r["x"], r["_failed"]) for r in cls.collect() if r["x"] is not None) == [(3, [])]
    assert [r["_failed"] for r in cls.collect() if r["x"] is None] == [["x_pos"]]


def test_accepted_plus_rejected_is_input(spark):
    from medalla.sources import adapters

    from .conftest import SF_SMOKE

    for name, spec in silver.SPECS.items():
        bronze = adapters.BY_SOURCE[name](spark, SF_SMOKE)
        cls = silver.classified(spec, bronze)
        assert quality.accepted(cls).count() + quality.rejected(cls).count() == bronze.count(), name


def test_warn_rule_keeps_row_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, d string")
    rules = [Rule("d_present", "d IS NOT NULL", quality.WARN)]
    cls = quality.classify(df, rules)
    assert quality.accepted(cls).count() == 2
    counts = df.agg(*quality.counter_columns(rules)).first()
    assert (counts["rows_in"], counts["failed_d_present"]) == (2, 1)


def test_observed_counters_fill_on_write(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    obs = Observation("rules")
    rules = [Rule("x_pos", "x > 0")]
    out = quality.accepted(quality.classify(df.observe(obs, *quality.counter_columns(rules)), rules))
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows_in": 3, "failed_x_pos": 2}
