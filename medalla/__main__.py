"""``python -m medalla`` (or ``spark-submit medalla/__main__.py``): one scheduled run.

Everything comes from the session configuration (``medalla.*`` keys, see
``config.PipelineConfig``); the cluster's settings are kept and only missing
runtime defaults are filled in.  Prints the run summary as JSON.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from .config import PipelineConfig
from .flows import run_once
from .session import apply_defaults


def main() -> None:
    spark = SparkSession.builder.appName("medalla").getOrCreate()
    apply_defaults(spark)
    summary = run_once(spark, PipelineConfig.from_spark(spark))
    print(json.dumps(summary, default=str))


if __name__ == "__main__":
    main()
