"""Sessions and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build(
    app: str = "tamis", master: str | None = None, *, hive: bool = False, **conf: str
) -> SparkSession:
    """A session with the web page off; AQE and its skew handling are Spark's defaults.

    With ``hive``, tables are kept in the configured metastore and outlive the session.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tamis-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where all tasks share this machine, may fall back to a
    temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
