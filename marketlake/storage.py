"""Where intermediate tables live.

A cluster names a folder every executor can reach in ``spark.checkpoint.dir``. Only a local-mode
session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="marketlake-")
    return _local_root[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared root, never handed out twice."""
    return f"{shared_root(spark)}/marketlake/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written under the shared root, or over what ``path`` holds, and read back: evaluated once."""
    path = path or work_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
