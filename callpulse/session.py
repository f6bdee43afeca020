"""Building a session, and the shared folder for written state."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "callpulse", **settings: str) -> SparkSession:
    """A session. Cluster sizing stays with the caller.

    ``settings`` are Spark settings with ``__`` for each dot, for instance
    ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's checkpoint folder.

    What is written there stays until its owner or the cluster's own retention
    removes it: a returned table may be read at any later time.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
