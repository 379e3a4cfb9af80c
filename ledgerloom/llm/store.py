"""Written intermediate tables, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a temporary folder is set once in a local session, and a cluster refuses,
    since its executors would write where the driver can't read."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not context.isLocal():
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir().get().rstrip("/")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there, and lost executors lose
    nothing.  Returns the table and its path, for ``dropped``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
