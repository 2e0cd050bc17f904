"""Session factory and the shared folder for intermediate files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


def get_spark(app_name: str = "jobsignals", conf: Mapping[str, str] | None = None,
              log_level: str = "ERROR") -> SparkSession:
    """The running session, or a new one. Master, connector packages and the
    default file system come from ``conf`` or from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local-mode session without
    that setting gets a temporary folder; on a cluster the setting is required,
    since a lost executor's own disk is lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local($|\[)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="jobsignals-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
