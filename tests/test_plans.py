"""Physical-plan properties the design relies on."""

import re

from medalla.plans import catalog

from .conftest import SF_SMOKE


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan):
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_returns_filter_reaches_the_parquet_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(catalog.returns_clean(spark, SF_SMOKE))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan


def test_scans_read_only_the_columns_used(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    schemas = _read_schemas(_plan(catalog.sales_clean(spark, SF_SMOKE)))
    assert schemas and all("l_discount" not in s and "l_tax" not in s and "l_returnflag" not in s for s in schemas)
    schemas = _read_schemas(_plan(catalog.products_clean(spark, SF_SMOKE)))
    assert schemas and all("p_size" not in s for s in schemas)


def test_gold_aggregates_before_joining_and_has_no_python(spark):
    plan = _plan(catalog.product_sales_returns(spark, SF_SMOKE))
    # every join input on the fact side is already aggregated per product
    assert plan.count("HashAggregate") >= 4
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan


def test_silver_has_one_shuffle_per_feed(spark):
    plan = _plan(catalog.sales_clean(spark, SF_SMOKE))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_min" in plan
