"""New folders in the one that the cluster names for all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a temporary one only where that is unset and all runs on one machine, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewell-")
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"
