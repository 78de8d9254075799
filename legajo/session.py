"""Session helpers: local defaults, shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "legajo") -> SparkSession:
    """A local session for tests and the benchmark, with a scratch folder; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="legajo-"))
        .config("spark.driver.memory", os.environ.get("LEGAJO_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Executors must all see it, so the cluster's own setting is used. Only a
    session in one process without one (a local test) gets a temporary folder.
    What is written there is the caller's to remove.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # "local-cluster" has executors of its own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="legajo-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
