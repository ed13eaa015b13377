"""Pipeline configuration read from the Spark session.

Every location and knob comes from ``spark.conf`` keys under ``medalla.*`` so
one build runs against dev, test and prod by changing session settings only.
Shared state (stream checkpoints, lineage cuts) lives under the cluster's
``spark.checkpoint.dir``; a private default is set only when it is unset, as in
tests.
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from .sources.schemas import SOURCE_FOLDERS

PREFIX = "medalla."


def normalise_path(path: str) -> str:
    """Drop duplicate and trailing slashes but keep the URI scheme intact."""
    if "://" in path:
        scheme, rest = path.split("://", 1)
        while "//" in rest:
            rest = rest.replace("//", "/")
        return f"{scheme}://{rest.rstrip('/')}"
    while "//" in path:
        path = path.replace("//", "/")
    return path.rstrip("/") or "/"


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` is the cluster's shared, fault-tolerant folder
    (a core setting, fixed when the context starts).  Only when it is unset and
    the master is local (a test session) is a private folder created - once per
    application - and registered with ``SparkContext.setCheckpointDir``; on any
    other master that is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.split("[")[0] == "local":  # an executor would write to a disk of its own
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        current = _LOCAL_ROOTS.get(sc.applicationId)
        if current is None:
            current = tempfile.mkdtemp(prefix="medalla-ckpt-")
            _LOCAL_ROOTS[sc.applicationId] = current
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(current)
    return normalise_path(current)


@dataclass(frozen=True)
class PipelineConfig:
    """Where the layers live and how the run behaves.

    ``warehouse``   root folder of the bronze, silver and gold tables
    ``landing``     root folder of the incoming files (one sub-folder per source)
    ``landing_folders`` each feed's sub-folder (``medalla.landing.<feed>``)
    ``checkpoints`` root folder of the streaming checkpoints (shared storage)
    ``run_ts``      one timestamp stamped on every row written by this run
    ``history_buckets`` number of key buckets of the employee history table
    ``dedup_first`` reference order: de-duplicate before the rules (S4)
    ``full_refresh`` recompute incremental Gold marts from all of Silver
    ``privileged``  reader may see personal data unmasked
    ``dedup_watermark`` optional delay bounding streaming de-dup state
    ``partials_compact_after`` live per-batch partial partitions before they
                    are folded into one compaction
    ``run_duration_warn_seconds`` a longer run is logged at WARN level
    ``max_files_per_trigger`` files per micro-batch (a backlog is worked off
                    in bounded, separately committed batches); 0 = no limit
    ``generation``  namespace of everything derived from Bronze (Silver,
                    quarantine, Gold, ops and their stream checkpoints).  A new
                    generation rebuilds them all from Bronze; Bronze itself and
                    its checkpoints are shared by every generation, so it is
                    never reset (append-only).
    """

    warehouse: str
    landing: str
    checkpoints: str
    run_ts: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    history_buckets: int = 64
    dedup_first: bool = False
    full_refresh: bool = False
    privileged: bool = False
    generation: str = "g0"
    dedup_watermark: str | None = None
    max_files_per_trigger: int | None = 1000
    partials_compact_after: int = 30
    run_duration_warn_seconds: float = 1200.0
    jdbc_options: tuple[tuple[str, str], ...] = ()
    landing_folders: tuple[tuple[str, str], ...] = tuple(SOURCE_FOLDERS.items())

    def table_path(self, layer: str, name: str) -> str:
        if layer == "bronze":
            return normalise_path(f"{self.warehouse}/bronze/{name}")
        return normalise_path(f"{self.warehouse}/{self.generation}/{layer}/{name}")

    def landing_path(self, source: str) -> str:
        return normalise_path(f"{self.landing}/{dict(self.landing_folders).get(source, source)}")

    def checkpoint_path(self, flow: str) -> str:
        if flow.startswith("bronze_"):
            return normalise_path(f"{self.checkpoints}/{flow}")
        return normalise_path(f"{self.checkpoints}/{self.generation}/{flow}")

    def with_options(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

    @classmethod
    def from_spark(cls, spark: SparkSession, **overrides) -> "PipelineConfig":
        conf = spark.conf
        ckpt = checkpoint_root(spark)

        def get(key: str, default: str | None = None) -> str | None:
            return conf.get(PREFIX + key, default)

        warehouse = overrides.pop("warehouse", None) or get("warehouse") or f"{ckpt}/warehouse"
        landing = overrides.pop("landing", None) or get("landing") or f"{ckpt}/landing"
        checkpoints = overrides.pop("checkpoints", None) or get("checkpoints") or f"{ckpt}/streams"
        kw = dict(
            warehouse=normalise_path(warehouse),
            landing=normalise_path(landing),
            checkpoints=normalise_path(checkpoints),
            history_buckets=int(get("history_buckets", "64")),
            dedup_first=(get("dedup_first", "false").lower() == "true"),
            full_refresh=(get("full_refresh", "false").lower() == "true"),
            privileged=(get("privileged", "false").lower() == "true"),
            generation=get("generation", "g0"),
            dedup_watermark=get("dedup_watermark", None) or None,
            max_files_per_trigger=int(get("max_files_per_trigger", "1000")) or None,
            partials_compact_after=int(get("partials_compact_after", "30")),
            run_duration_warn_seconds=float(get("run_duration_warn_seconds", "1200")),
        )
        jdbc = {k[len(PREFIX + "jdbc."):]: v for k, v in _conf_items(spark) if k.startswith(PREFIX + "jdbc.")}
        folders = {s: get(f"landing.{s}", folder) for s, folder in SOURCE_FOLDERS.items()}
        kw["landing_folders"] = tuple(folders.items())
        if jdbc:
            kw["jdbc_options"] = tuple(sorted(jdbc.items()))
        kw.update(overrides)
        return cls(**kw)


def _conf_items(spark: SparkSession):
    try:
        return list(spark.conf.getAll.items())  # type: ignore[attr-defined]
    except Exception:
        return list(spark.sparkContext.getConf().getAll())
