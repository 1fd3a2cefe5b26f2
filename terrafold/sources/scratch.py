"""Tables in the folder that driver and executors share: lineage is cut there, and what nothing reads any more is deleted."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under spark.checkpoint.dir. Where that is unset, a local session (tests) gets a local folder; a cluster raises."""
    root = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{KEY} must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="terrafold-")
        spark.conf.set(KEY, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table as written to a fresh path and read again, so that a lost executor repeats one step and no earlier one."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more; other tables are left alone."""
    for df in tables:
        if path := getattr(df, "scratch_path", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
