"""Session-level helpers: shared scratch space and checkpointing."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def _local_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    folder = tempfile.mkdtemp(prefix="feedloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    In a local session without the setting (tests) a temporary folder stands in, gone with the
    process. On a cluster a machine's own folder would lose files, so the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.sparkContext.getCheckpointDir()
    if configured is None:
        configured = _local_folder(spark.sparkContext.master)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
