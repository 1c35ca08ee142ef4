"""The folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import urllib.parse
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no checkpoint folder (tests on one machine).
LOCAL_FALLBACK = "file:///tmp/linkloom-shared"


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the context's checkpoint folder. Without either, a local one on one machine; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = LOCAL_FALLBACK
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_root(spark)}/linkloom/{name}-{uuid.uuid4().hex[:12]}"

    def end() -> None:
        if path.startswith("file:"):
            shutil.rmtree(urllib.parse.urlparse(path).path, ignore_errors=True)
        elif spark.sparkContext._jsc is not None:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    atexit.register(end)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a file in the shared folder, for what is read several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
