"""Folders that the driver and all executors share, for tables between two steps."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, in the warehouse, or locally in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        base = "file://" + tempfile.mkdtemp(prefix="modlake-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/modlake-work/{name}-{uuid.uuid4().hex}"
