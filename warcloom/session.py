"""Session settings the expressions rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONFS = {
    # legacy charsets and "replace malformed bytes" are what make decode() work on archived pages
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    # a repeated header keeps its last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    # joins here never force a broadcast: AQE picks it from measured sizes and splits hot keys otherwise
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; safe to call again and again, on a session owned by somebody else."""
    for key, value in REQUIRED_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app_name: str = "warcloom", master: str | None = None, **confs: str) -> SparkSession:
    """A session with the settings; `confs` use `__` for the dots of a configuration key."""
    builder = SparkSession.builder.appName(app_name)
    # building large expressions is faster without a call site per function
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in confs.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables that later stages read again.

    It lies in the folder the cluster shares (`spark.checkpoint.dir`), so it outlives a lost executor. Only a local
    session without that setting, as in a test, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        root = tempfile.mkdtemp(prefix="warcloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, purpose: str, group_bytes: int | None = None) -> DataFrame:
    """Rows written to the shared folder and read back: computed once, lineage cut, size known to the optimizer.

    Large rows are read a row group at a time, of which `group_bytes` bounds the size; files are then checked row by row.
    """
    path = shared_folder(rows.sparkSession, purpose)
    sized = {"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 1} if group_bytes else {}
    rows.write.options(**sized).parquet(path)
    return rows.sparkSession.read.parquet(path)
