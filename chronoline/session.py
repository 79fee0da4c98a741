"""Spark session settings and shared-folder helpers."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings this package relies on; an existing session keeps its own values.
SESSION_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot compiles no method above 8000 bytes; Spark then generates split ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "chronoline", extra: dict | None = None) -> SparkSession:
    """A session with :data:`SESSION_CONF`; ``master`` defaults to ``local[*]``."""
    b = SparkSession.builder.appName(app_name)
    if master or not os.environ.get("SPARK_REMOTE"):
        b = b.master(master or "local[*]")
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  When neither is set, a session in one process (local tests)
    gets a folder under the system temp dir, registered as the checkpoint dir; on a
    cluster it is an error, as executors could not see such a folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        d = tempfile.mkdtemp(prefix="chronoline-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under :func:`shared_dir` (nothing is created)."""
    return f"{shared_dir(spark)}/chronoline/{name}-{uuid.uuid4().hex[:12]}"
