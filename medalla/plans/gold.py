"""Gold: the four published marts.

All four aggregate *before* any join (one row per product / category key), so
joins never multiply fact rows, and every aggregate is decomposable so Spark
runs a partial (map-side) aggregation: a hot branch, product or category is
reduced on the map side and never lands whole in one reducer.

Keys are unique after Silver de-duplication (sales, returns, reviews) and the
current employee view has one row per employee, so distinct counts are plain
counts: the same number without the ``Expand`` + two-level aggregation Spark
plans for ``count(DISTINCT ...)``.  Where de-duplication is bounded in time
(``dedup_watermark``) a key may come again: then the marts are computed with
``repeats=True``, which counts distinct keys.  Joins carry no hints: dimension sides are
aggregated first and Spark (with AQE) broadcasts them only when their measured
size is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise it keeps a
sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATE = T.DecimalType(24, 0)
TOTAL = T.DecimalType(38, 2)  # money partials: one fixed type however often they are summed
MART_MONEY = T.DecimalType(23, 2)  # published money columns, as in the table contract


def _n(key: str, repeats: bool, where=None):
    """Number of keys; of distinct ones where a key may repeat."""
    col = F.col(key) if where is None else F.when(where, F.col(key))
    return F.count_distinct(col) if repeats else F.count(col)


def sales_by_branch_month(sales: DataFrame, repeats: bool = False) -> DataFrame:
    return sales.groupBy(
        "branch_id",
        F.year("sale_date").alias("year"),
        F.month("sale_date").alias("month"),
    ).agg(
        _n("sale_id", repeats).alias("sales_count"),
        F.sum("quantity").alias("units_sold"),
        F.round(F.sum("amount"), 2).alias("sales_total"),
        F.round(F.avg("amount"), 2).alias("avg_ticket"),
    )


def sales_per_product(sales: DataFrame, repeats: bool = False) -> DataFrame:
    """Additive per-product partials of the sales facts (sums and counts), so
    partials of disjoint row sets can be summed again."""
    return sales.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        _n("sale_id", repeats).alias("sales_count"),
        F.sum("amount").cast(TOTAL).alias("sales_amount"),
    )


def returns_per_product(returns: DataFrame, repeats: bool = False) -> DataFrame:
    return returns.groupBy("product_id").agg(
        _n("return_id", repeats).alias("returns_count"),
        F.sum("refund").cast(TOTAL).alias("refund_amount"),
    )


def reviews_per_product(reviews: DataFrame, repeats: bool = False) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        _n("review_id", repeats).alias("n"),
        _n("review_id", repeats, F.col("rating") <= 2).alias("neg"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rated"),
    )


#: Additive per-product partials of each fact table: (Silver table, how to make them).
PARTIAL_LOGS = {
    "sales_by_product": ("sales", sales_per_product),
    "returns_by_product": ("returns", returns_per_product),
    "reviews_by_product": ("reviews", reviews_per_product),
}


def merge_partials(partials: DataFrame) -> DataFrame:
    """Sum stacked partials (e.g. one set per run) back to one row per product."""
    measures = [f for f in partials.schema.fields if f.name not in ("product_id", "run")]
    return partials.groupBy("product_id").agg(
        *[F.sum(f.name).cast(f.dataType if isinstance(f.dataType, T.DecimalType) else "bigint").alias(f.name) for f in measures]
    )


def products_with_totals(products: DataFrame, sales_partials: DataFrame, returns_partials: DataFrame) -> DataFrame:
    joined = (
        products.select("product_id", "product_name", "category", "brand")
        .join(sales_partials, "product_id", "left")
        .join(returns_partials, "product_id", "left")
    )
    return joined.select(
        "product_id",
        "product_name",
        "category",
        "brand",
        F.coalesce(F.col("units_sold"), F.lit(0)).cast("bigint").alias("units_sold"),
        F.coalesce(F.col("sales_count"), F.lit(0)).alias("sales_count"),
        F.coalesce(F.round(F.col("sales_amount"), 2), F.lit(0)).cast(MART_MONEY).alias("sales_amount"),
        F.coalesce(F.col("returns_count"), F.lit(0)).alias("returns_count"),
        F.coalesce(F.round(F.col("refund_amount"), 2), F.lit(0)).cast(MART_MONEY).alias("refund_amount"),
    )


def product_sales_returns(products: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    return products_with_totals(products, sales_per_product(sales), returns_per_product(returns))


def headcount_by_branch(current_employees: DataFrame) -> DataFrame:
    return current_employees.groupBy("branch_id").agg(F.count("employee_id").alias("active_employees"))


def rate_by_category(per_product: DataFrame, products: DataFrame) -> DataFrame:
    by_cat = (
        per_product.join(products.select("product_id", "category"), "product_id", "inner")
        .groupBy("category")
        .agg(
            F.sum("n").alias("total_reviews"),
            F.sum("neg").alias("negative_reviews"),
            F.sum("rating_sum").alias("rating_sum"),
            F.sum("rated").alias("rated"),
        )
    )
    rate = F.try_divide(F.col("negative_reviews").cast(RATE) * 100, F.col("total_reviews").cast(RATE))
    return by_cat.select(
        "category",
        "total_reviews",
        "negative_reviews",
        F.round(F.try_divide(F.col("rating_sum").cast("double"), F.col("rated").cast("double")), 2).alias("avg_rating"),
        F.round(rate, 2).cast("double").alias("negative_rate"),
    )


def negative_review_rate(reviews: DataFrame, products: DataFrame) -> DataFrame:
    return rate_by_category(reviews_per_product(reviews), products)
