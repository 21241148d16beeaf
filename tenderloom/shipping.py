"""What runs beyond the driver needs: this package in Python workers, and a folder that all share."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers once per application, unless PYTHONPATH already leads there."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    if str(ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="spark-")
    target = f"{folder}/{ROOT.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, p.relative_to(ROOT.parent))
    spark.sparkContext.addPyFile(target)


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where that is unset and all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    return folder.rstrip("/")
