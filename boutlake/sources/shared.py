"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; without that setting a local master gets a temporary folder and a cluster an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        top = getattr(spark, "_boutlake_shared", None)
        if top is None:
            top = spark._boutlake_shared = "file://" + tempfile.mkdtemp(prefix="boutlake-")
    return f"{top.rstrip('/')}/boutlake/{name}-{uuid.uuid4().hex}"
