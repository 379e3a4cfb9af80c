"""Members of ZIP, TAR and single JSON exports."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.archives import _KINDS, _NAMES, BROKEN, MEMBERS, Reading, listed, members_of, opened, read_archives, refused


def _whole(reading: Reading):
    """Rows of exports that are held whole, each opened in the task that reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = data.as_py()
                kind, members = listed(io.BytesIO(data), len(data), source, reading)
                try:
                    kind, members = ("", members[-1:]) if refused(members) else (kind, members)
                    for row in members_of(io.BytesIO(data), kind, source, members, len(data), reading):
                        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS)], names=_NAMES)
                except BROKEN as error:
                    broken = (source, "", 0, None, False, b"", None, None, f"invalid_container: {type(error).__name__}", None, None)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(broken, _KINDS)], names=_NAMES)

    return run


def read_exports(spark: SparkSession, path: str, max_member: int = 2_147_483_648, max_entries: int = 100_000, reading: Reading | None = None) -> DataFrame:
    """One row per member of every export under ``path``, a file or folder: source, path, size_bytes, compressed_bytes, is_link,
    head, sha256, content, problem.

    Ranges of members are read by tasks of their own (``archives``).  In a store that Arrow can't open, Spark's binary file source reads
    each export whole, up to 2 GiB."""
    reading = reading or Reading(max_member=max_member, max_entries=max_entries)
    try:
        opened(path)
        rows = read_archives(spark, path, reading)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_whole(reading), MEMBERS)
    return rows.where("piece is null").drop("piece", "piece_start")


def read_export_pieces(spark: SparkSession, path: str, reading: Reading = Reading(piece=1 << 20)) -> DataFrame:
    """source, path, piece, piece_start, content: the consecutive pieces of members that are too large for a row of ``read_exports``."""
    return read_archives(spark, path, reading).where("piece is not null").select("source", "path", "piece", "piece_start", "content")
