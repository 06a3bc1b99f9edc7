"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, also used for ``checkpoint()``.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of its own; on a cluster the missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if sc.getCheckpointDir() is None:
        if not configured:
            if not sc.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
