"""Consolidated quarantine of every rejected row, and its summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import silver


def quarantine(bronze: Mapping[str, DataFrame], run_ts: dt.datetime | None = None) -> DataFrame:
    """Union (by name, duplicates kept) of the rejects of every feed."""
    parts = [silver.rejects(silver.SPECS[name], df, run_ts) for name, df in bronze.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def summary(quarantined: DataFrame) -> DataFrame:
    """Rejects per feed and reason, most frequent first."""
    return (
        quarantined.groupBy("source_table", "reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "source_table", "reason")
    )


def rule_counters(bronze: Mapping[str, DataFrame]) -> DataFrame:
    parts = [silver.rule_counters(silver.SPECS[name], df) for name, df in bronze.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
