"""Sending this package to executors, which need not have it installed."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the executors' import path, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    with tempfile.TemporaryDirectory() as folder:
        kept = os.path.join(folder, "kept", "barloom")
        shutil.copytree(os.path.join(root, "barloom"), kept, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(os.path.join(folder, "barloom"), "zip", os.path.dirname(kept))
        lasting = os.path.join(tempfile.mkdtemp(prefix="barloom-"), "barloom.zip")
        shutil.copy(archive, lasting)
    spark.sparkContext.addPyFile(lasting)
    _sent.add(app)
