"""Row-count checks, the run log and its newest entries (J3-J5, F2, G2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("level", T.StringType(), False),
        T.StructField("message", T.StringType(), True),
    ]
)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, rows, ok) row per table; ``ok`` = the table is not empty."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("ok", F.col("rows") > 0)


def latest(log: DataFrame, n: int = 100, ts: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Newest ``n`` entries: a top-k (``TakeOrderedAndProject``), no full sort."""
    order = [F.col(ts).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return log.orderBy(*order).limit(n)


class RunLog:
    """Append-only run log stored as a Parquet table.

    Entries are a handful of small records per run (stage timings, counters),
    never data rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._pending: list[tuple] = []

    def add(self, event_type: str, message: str, level: str = "INFO", at: dt.datetime | None = None) -> None:
        at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._pending.append((at, event_type, level, message))

    def flush(self) -> None:
        if not self._pending:
            return
        self.spark.createDataFrame(self._pending, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self._pending = []

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG_SCHEMA).parquet(self.path)

    def latest(self, n: int = 100) -> DataFrame:
        """The newest ``n`` entries (the reference's "latest events" query)."""
        return latest(self.read(), n)
