"""Session settings and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build(master: str = "local[8]", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path under spark.checkpoint.dir; in local mode alone a temporary one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/tidemark/{tag}-{uuid.uuid4().hex}"
