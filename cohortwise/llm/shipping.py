"""Gives Python workers this package when their path does not have it."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """On a local master workers find the package through PYTHONPATH or the
    folder Spark was started in. Else, and always on a cluster, whose executors
    have neither, it is sent along as a zip file, once per application."""
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or local and any(p and os.path.realpath(p) == os.path.realpath(ROOT) for p in paths):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="cohortwise-ship-"), "cohortwise")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", ROOT, "cohortwise"))
    _SHIPPED.add(app)
