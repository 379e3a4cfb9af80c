"""Files of a tree with their hashes, read by tasks that each take a range of files."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom.sources.archives import CHUNK, files_under, opened, uri_of
from ledgerloom.sources.checkpoints import written

TREE = "path string, size_bytes bigint, modified bigint, sha256 string, problem string"
SPLIT = 134_217_728


class FileRange(InputPartition):
    """Files that one task hashes: (path, path under the root, bytes, time in nanoseconds, problem)."""

    def __init__(self, files: list[tuple]):
        self.files = files


class TreeReader(DataSourceReader):
    def __init__(self, uri: str):
        self.uri = uri

    def partitions(self) -> list[FileRange]:
        store, root = opened(self.uri)
        local = isinstance(store, fs.LocalFileSystem)
        parts: list[list[tuple]] = [[]]
        weight = 0
        for info in files_under(self.uri):
            link = local and os.path.islink(info.path)
            own = (uri_of(info, self.uri), os.path.relpath(info.path, root), info.size, info.mtime_ns or 0, "symlink_member" if link else None)
            if weight and weight + info.size > SPLIT:
                parts.append([])
                weight = 0
            parts[-1].append(own)
            weight += info.size
        return [FileRange(p) for p in parts]

    def read(self, partition: FileRange) -> Iterator[tuple]:
        for uri, relative, size, modified, problem in partition.files:
            digest = hashlib.sha256()
            if not problem:
                store, path = opened(uri)
                with store.open_input_stream(path) as stream:
                    while data := stream.read(CHUNK):
                        digest.update(data)
            yield relative, size, modified, None if problem else digest.hexdigest(), problem


class TreeSource(DataSource):
    """``spark.read.format("file_tree")``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return TREE

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options["path"])


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, size_bytes of every file under ``path``, relative to it; a link is refused."""
    return read_listing(spark, path).select("path", F.when(F.col("problem").isNotNull(), F.raise_error(F.concat_ws(": ", "problem", "path"))).otherwise(F.col("sha256")).alias("sha256"), "size_bytes")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """path, size_bytes, modified, sha256, problem of every file under ``path``; files are hashed as they stream by."""
    spark.dataSource.register(TreeSource)
    return spark.read.format(TreeSource.name()).load(path)


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The listing of ``path`` as it is now, kept in the shared folder."""
    return written(read_listing(spark, path), "snapshot")


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """code, subject of files that two listings (path, size_bytes, sha256) don't both have alike."""
    now = after.select(F.col("path").alias("now_path"), F.col("size_bytes").alias("now_size"), F.col("sha256").alias("now_sha256"))
    same = F.col("size_bytes").eqNullSafe(F.col("now_size")) & F.col("sha256").eqNullSafe(F.col("now_sha256"))
    both = before.join(now, F.col("path") == F.col("now_path"), "full_outer")
    different = F.col("path").isNull() | F.col("now_path").isNull() | ~same
    return both.where(different).select(F.lit("source_changed").alias("code"), F.coalesce("path", "now_path").alias("subject"))
