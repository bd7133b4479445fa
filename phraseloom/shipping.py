"""Sends this package to the executors, whose workers need it where a function refers to its modules."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession | None) -> None:
    """Once for each context; does nothing without a session."""
    if spark is None or getattr(spark.sparkContext, "_phraseloom_sent", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="phraseloom-zip-")) / "phraseloom_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((top / "phraseloom").rglob("*.py")):
            z.write(p, p.relative_to(top))
    spark.sparkContext.addPyFile(str(target))
    spark.sparkContext._phraseloom_sent = True
