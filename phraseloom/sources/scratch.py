"""Folders for tables that a job writes and reads back."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir. Only a local master may do without that setting."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = spark.conf.get("phraseloom.scratch.dir", None)
        if conf is None:
            conf = Path(tempfile.mkdtemp(prefix="phraseloom-")).as_uri()
            spark.conf.set("phraseloom.scratch.dir", conf)
    return f"{conf.rstrip('/')}/phraseloom-io/{label}-{uuid.uuid4().hex}"
