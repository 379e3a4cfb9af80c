"""Where lineage is cut: rows that depend on how Spark dealt them are written once, to a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_WRITTEN: list[str] = []  # what this driver has written and not cleared


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  A local session without one gets a temporary folder; a cluster without one refuses, since
    its executors would write where the others can't read."""
    context = spark.sparkContext
    own = context._jsc.sc()
    if own.getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not own.isLocal():
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ledgerloom-"))
    return own.getCheckpointDir().get().rstrip("/")


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as Parquet in the shared folder, for rows that are read more than once and not always whole."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    _WRITTEN.append(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows``, written to the shared folder and read from there."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def clear(spark: SparkSession) -> int:
    """Delete the tables that ``written`` has left, once nothing that reads them is wanted any more; how many there were."""
    paths, _WRITTEN[:] = list(_WRITTEN), []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
