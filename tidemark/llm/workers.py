"""Python workers of a local session find this package where the driver found it."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder of the package on the workers' path; clusters get the package by --py-files.

    Each worker's linear algebra keeps to one thread: Spark runs as many workers as there are cores.
    """
    settings = spark.sparkContext.environment
    settings.update(dict.fromkeys(("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"), "1"))
    paths = [p for p in settings.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        settings["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
