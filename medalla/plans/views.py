"""SQL access: temporary views over the written tables (A17), the Gold
row-count check as one ``UNION ALL`` statement (G2) and a masked view of the
current staff (J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import PipelineConfig
from ..sources import storage
from . import governance

LAYERS = {
    "bronze": ("sales", "returns", "reviews", "employees", "products", "tracking"),
    "silver": (
        "sales",
        "returns",
        "reviews",
        "review_replies",
        "products",
        "tracking",
        "employee_events",
        "employee_history",
        "employees_current",
    ),
    "quarantine": ("sales", "returns", "reviews", "employees", "products", "tracking"),
    "gold": ("sales_by_branch_month", "product_sales_returns", "headcount_by_branch", "negative_review_rate"),
    "ops": ("run_log", "gold_row_counts"),
}


def register_views(spark: SparkSession, cfg: PipelineConfig) -> list[str]:
    """``<layer>_<table>`` temp views for every table that exists, plus
    ``silver_employees_current_masked`` (personal data masked unless
    ``cfg.privileged``)."""
    from ..streaming import flows  # which imports the plans

    names = []
    for layer, tables in LAYERS.items():
        for t in tables:
            path = cfg.table_path(layer, t)
            if storage.readable(spark, path):
                name = f"{layer}_{t}"
                rows = flows.read_history(spark, cfg) if name == "silver_employee_history" else storage.read(spark, path)
                rows.drop("batch_id").createOrReplaceTempView(name)
                names.append(name)
    if "silver_employees_current" in names:
        names.append(
            masked_staff_view(spark, spark.table("silver_employees_current"), cfg.privileged, "silver_employees_current_masked")
        )
    return names


def gold_row_counts_sql(spark: SparkSession) -> DataFrame:
    """The row-count check in SQL over the registered Gold views."""
    parts = [f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM gold_{t}" for t in LAYERS["gold"]]
    return spark.sql("SELECT table_name, rows, rows > 0 AS ok FROM (" + " UNION ALL ".join(parts) + ")")


def masked_staff_view(spark: SparkSession, current: DataFrame, privileged: bool, name: str = "employees_current_masked") -> str:
    """A view that calls the mask function on every tagged column, so who reads
    decides: the function asks for the reader's name (``privileged`` names the
    one who makes the view).  The columns are text for every reader."""
    governance.register_mask_function(spark, [spark.sql("SELECT current_user()").first()[0]] if privileged else [])
    governance.masked_by_function(governance.tag_pii(current)).createOrReplaceTempView(name)
    return name
