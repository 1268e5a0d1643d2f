"""A place for files that checks write and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, or below a temporary folder where that is unset and all runs on this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="checks-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared}/{name}-{uuid.uuid4().hex}"
