"""Session builder for tests, the benchmark and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None, app: str = "medalla") -> SparkSession:
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # checkpoints of the sequence operator are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


# Runtime settings the pipeline is designed around.  ``apply_defaults`` only
# fills keys the cluster has not set, so the cluster's own tuning wins.
RUNTIME_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def _explicitly_set(spark: SparkSession) -> set[str]:
    """Keys set by the cluster, the submit command or the session (not the
    built-in defaults, which ``spark.conf.get`` also returns)."""
    keys = {k for k, _ in spark.sparkContext.getConf().getAll()}
    try:
        keys |= set(spark.conf.getAll)  # PySpark 4: the session's set keys
    except Exception:
        pass
    return keys


def apply_defaults(spark: SparkSession) -> dict[str, str]:
    """Set each of ``RUNTIME_DEFAULTS`` that nobody set explicitly; returns
    what was set."""
    given = _explicitly_set(spark)
    applied = {}
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
            applied[key] = value
    return applied
