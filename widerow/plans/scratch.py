"""Where a query may write a table of its own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``, deleted when the
    session's JVM ends. Only a local session, where every task sees this machine's
    disk, may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all nodes share")
        root = tempfile.mkdtemp(prefix="widerow-")
    own = f"{root.rstrip('/')}/widerow-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{own}/table"


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once and read back: later uses neither compute it
    again nor depend on executors that held its parts."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
