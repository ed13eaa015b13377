"""Named queries over the shared test tables.

Each query derives the retail feeds from the test tables (``sources.adapters``)
and runs the real Silver / Gold code on them over the whole tables.  Results
go through ``portable`` - decimals as DOUBLE, integers as BIGINT, timestamps
as wall-clock TIMESTAMP_NTZ - so a second engine can reproduce them exactly;
run-time stamps (``updated_at``, ``rejected_at``) are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import adapters
from . import employees, gold, governance, monitoring, quarantine, silver

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
            c = F.array_join(c, "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _bronze(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: adapters.BY_SOURCE[n](spark, sf_dir) for n in names}


def _clean(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.clean(silver.SPECS[name], adapters.BY_SOURCE[name](spark, sf_dir))


def sales_clean(spark, sf_dir):
    return portable(_clean(spark, sf_dir, "sales"))


def returns_clean(spark, sf_dir):
    return portable(_clean(spark, sf_dir, "returns"))


def products_clean(spark, sf_dir):
    return portable(_clean(spark, sf_dir, "products"))


def reviews_clean(spark, sf_dir):
    return portable(_clean(spark, sf_dir, "reviews").drop("replies"))


def review_replies(spark, sf_dir):
    return portable(silver.review_replies(adapters.threaded_reviews(spark, sf_dir)))


def tracking_clean(spark, sf_dir):
    return portable(_clean(spark, sf_dir, "tracking"))


def employee_events_clean(spark, sf_dir):
    return portable(_clean(spark, sf_dir, "employees"))


def _history(spark, sf_dir):
    return employees.history(_clean(spark, sf_dir, "employees"))


def employee_history(spark, sf_dir):
    return portable(_history(spark, sf_dir))


def employee_history_collapsed(spark, sf_dir):
    """Versions that differ from the one before in branch, job or kind of event."""
    return portable(employees.collapsed(_history(spark, sf_dir)))


def employees_current(spark, sf_dir):
    return portable(employees.current(_history(spark, sf_dir)))


def sales_by_branch_month(spark, sf_dir):
    return portable(gold.sales_by_branch_month(_clean(spark, sf_dir, "sales")))


def product_sales_returns(spark, sf_dir):
    return portable(
        gold.product_sales_returns(
            _clean(spark, sf_dir, "products"), _clean(spark, sf_dir, "sales"), _clean(spark, sf_dir, "returns")
        )
    )


def headcount_by_branch(spark, sf_dir):
    return portable(gold.headcount_by_branch(employees.current(_history(spark, sf_dir))))


def negative_review_rate(spark, sf_dir):
    return portable(gold.negative_review_rate(_clean(spark, sf_dir, "reviews"), _clean(spark, sf_dir, "products")))


ALL_SOURCES = ("sales", "returns", "reviews", "employees", "products", "tracking")


def payload_fields(payload: Column) -> Column:
    """Every field of a payload as ``name=value``, by name: JSON text is
    spelled differently by other engines.  Instants to the second."""
    fields = F.map_entries(F.from_json(payload, "map<string,string>"))
    value = lambda e: F.when(e["key"] == "ingested_at", F.substring(e["value"], 1, 19)).otherwise(e["value"])
    named = F.transform(fields, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(value(e), F.lit("<null>"))))
    return F.array_join(F.array_sort(named), "|")


def quarantine_rows(spark, sf_dir):
    q = quarantine.quarantine(_bronze(spark, sf_dir, *ALL_SOURCES))
    return portable(q.drop("rejected_at").withColumn("payload", payload_fields(F.col("payload"))))


def quarantine_summary(spark, sf_dir):
    return portable(quarantine.summary(quarantine.quarantine(_bronze(spark, sf_dir, *ALL_SOURCES))))


def rule_counters(spark, sf_dir):
    return portable(quarantine.rule_counters(_bronze(spark, sf_dir, *ALL_SOURCES)))


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sales = _clean(spark, sf_dir, "sales")
    products = _clean(spark, sf_dir, "products")
    return {
        "sales_by_branch_month": gold.sales_by_branch_month(sales),
        "product_sales_returns": gold.product_sales_returns(products, sales, _clean(spark, sf_dir, "returns")),
        "headcount_by_branch": gold.headcount_by_branch(employees.current(_history(spark, sf_dir))),
        "negative_review_rate": gold.negative_review_rate(_clean(spark, sf_dir, "reviews"), products),
    }


def gold_row_counts(spark, sf_dir):
    return portable(monitoring.row_counts(gold_tables(spark, sf_dir)))


def latest_events(spark, sf_dir):
    """Newest 100 entries of an event log shaped like the run log."""
    ev = adapters.table(spark, sf_dir, "events")
    log = ev.select(
        F.col("ts").alias("timestamp"),
        F.col("event_type"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
        F.col("props").alias("message"),
        F.col("event_id"),
    )
    return portable(monitoring.latest(log, 100, "timestamp", "event_id"))


def employees_masked(spark, sf_dir):
    cur = governance.tag_pii(employees.current(_history(spark, sf_dir)))
    return portable(governance.masked(cur, privileged=False))


def employees_masked_by_group(spark, sf_dir):
    """One view, two readers: nations are members of their region's group, and
    only Europe's sees personal data."""
    cur = governance.tag_pii(employees.current(_history(spark, sf_dir)))
    nations = adapters.table(spark, sf_dir, "nation").join(adapters.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = f"employees_{uuid.uuid4().hex[:8]}"
    nations.select(F.col("n_name").alias("member"), F.col("r_name").alias("group_name")).createOrReplaceTempView(f"{name}_groups")
    parts = []
    for reader in ("NATION_3", "NATION_0"):
        governance.create_masked_view(spark, cur, f"{name}_{reader}", f"{name}_groups", "EUROPE", f"'{reader}'")
        parts.append(spark.table(f"{name}_{reader}").withColumn("reader", F.lit(reader)))
    return portable(parts[0].unionByName(parts[1]))


QUERIES: dict[str, Query] = {
    "sales_clean": sales_clean,
    "returns_clean": returns_clean,
    "products_clean": products_clean,
    "reviews_clean": reviews_clean,
    "review_replies": review_replies,
    "tracking_clean": tracking_clean,
    "employee_events_clean": employee_events_clean,
    "employee_history": employee_history,
    "employee_history_collapsed": employee_history_collapsed,
    "employees_current": employees_current,
    "sales_by_branch_month": sales_by_branch_month,
    "product_sales_returns": product_sales_returns,
    "headcount_by_branch": headcount_by_branch,
    "negative_review_rate": negative_review_rate,
    "quarantine_rows": quarantine_rows,
    "quarantine_summary": quarantine_summary,
    "rule_counters": rule_counters,
    "gold_row_counts": gold_row_counts,
    "latest_events": latest_events,
    "employees_masked": employees_masked,
    "employees_masked_by_group": employees_masked_by_group,
}
