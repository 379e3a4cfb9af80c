"""Where an import's files go: retained bytes written by the tasks, and a tree that readers see whole or not at all."""

from __future__ import annotations

import hashlib
import os
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import is_unsafe_path, normalized_path
from ledgerloom.sources.archives import CHUNK, opened, stored

STORED = "path string, stored_path string, size_bytes bigint, sha256 string"


def _copied(stream, store: fs.FileSystem, target: str) -> tuple[int, str]:
    """Copy a stream and hash it in one pass; the file takes its name when it is whole, so a task that is run again
    replaces it."""
    own, size, digest = f"{target}.{uuid.uuid4().hex}.tmp", 0, hashlib.sha256()
    store.create_dir(os.path.dirname(target), recursive=True)
    with store.open_output_stream(own) as out:
        while data := stream.read(CHUNK):
            size += len(data)
            digest.update(data)
            out.write(data)
    store.move(own, target)
    return size, digest.hexdigest()


def _from_source(source: str, path: str, size: int, store: fs.FileSystem, target: str) -> tuple[int, str]:
    own, inner = opened(source)
    with stored(own, inner) as file:
        if zipfile.is_zipfile(file):
            with zipfile.ZipFile(file) as archive, archive.open(path) as stream:
                return _copied(stream, store, target)
        file.seek(0)
        try:
            with tarfile.open(fileobj=file, mode="r:*") as archive:
                return _copied(archive.extractfile(path), store, target)
        except tarfile.ReadError:
            file.seek(0)
            return _copied(file, store, target)


def retain(members: DataFrame, folder: str) -> DataFrame:
    """Write ``members`` (source, path, size_bytes, sha256, content) as files under ``folder`` by their paths, and give path, stored_path,
    size_bytes, sha256 of what was written.

    Payloads that their rows don't hold are copied from the archive as they stream by.  A path that is unsafe, or a payload
    that has not the hash it had when it was read, fails the job."""
    safe = F.when(is_unsafe_path(F.col("path")), F.raise_error(F.concat(F.lit("unsafe_path: "), "path"))).otherwise(normalized_path(F.col("path")))
    rows = members.select("source", "path", safe.alias("stored_path"), "size_bytes", "sha256", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        for batch in batches:
            done = []
            for source, path, name, size, expected, content in zip(*(batch.column(c) for c in ("source", "path", "stored_path", "size_bytes", "sha256", "content"))):
                target = f"{root.rstrip('/')}/{name.as_py()}"
                if content.is_valid:
                    found = _copied(pa.input_stream(content.as_buffer()), store, target)
                else:
                    found = _from_source(source.as_py(), path.as_py(), size.as_py(), store, target)
                if found[1] != expected.as_py():
                    raise ValueError(f"source_changed: {path.as_py()}")
                done.append((path.as_py(), name.as_py(), *found))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=[c.split(" ")[0] for c in STORED.split(", ")])

    return rows.mapInArrow(run, STORED)


class Store:
    """Renames and deletes through the Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.files.exists(self.path(path))

    def rename(self, old: str, new: str) -> None:
        # a rename onto a folder that exists would move into it
        if self.exists(new) or not self.files.rename(self.path(old), self.path(new)):
            raise OSError(f"can't move {old} to {new}")

    def delete(self, path: str) -> None:
        self.files.delete(self.path(path), True)

    def beside(self, output: str, mark: str) -> list[str]:
        """Paths beside ``output`` that were named after it with ``mark``."""
        parent, name = output.rstrip("/").rsplit("/", 1) if "/" in output.rstrip("/") else (".", output)
        pattern = self.path(f"{parent}/{name}.{mark}-*")
        return sorted(s.getPath().toString() for s in self.files.globStatus(pattern) or [])


def commit(store: Store, staging: str, output: str, replace: bool) -> None:
    """Move ``staging`` to ``output``.  An output that is there is refused, or set aside, replaced and then deleted; when the move fails it
    comes back.  A driver that dies between the two moves leaves it beside ``output``, where ``recover`` finds it."""
    backup = None
    if store.exists(output):
        if not replace:
            raise FileExistsError(output)
        backup = f"{output.rstrip('/')}.previous-{uuid.uuid4().hex}"
        store.rename(output, backup)
    try:
        store.rename(staging, output)
    except Exception:
        if backup is not None and not store.exists(output):
            store.rename(backup, output)
        raise
    if backup is not None:
        store.delete(backup)


def recover(spark: SparkSession, output: str) -> None:
    """Clear what a driver that died has left beside ``output``: bring back the tree that was set aside if ``output`` is gone, and delete the rest."""
    store = Store(spark, output)
    aside = store.beside(output, "previous")
    if aside and not store.exists(output):
        if len(aside) > 1:
            raise RuntimeError(f"more than one earlier {output}")
        store.rename(aside.pop(), output)
    for path in [*aside, *store.beside(output, "staging")]:
        store.delete(path)
