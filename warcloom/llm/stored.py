"""Tables written to the folder that a cluster shares, and read back: computed once, lineage cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame

_made: dict[str, str] = {}


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` as a Parquet table in the folder of spark.checkpoint.dir; a local session without one, as in a test, gets one."""
    spark = rows.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or _made.get(spark.sparkContext.applicationId)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        root = _made[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="warcloom-tables-")
    path = f"{root.rstrip('/')}/table-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def free_name(rows: DataFrame, wanted: str) -> str:
    """A column name that rows do not have."""
    taken = {x.lower() for x in rows.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
