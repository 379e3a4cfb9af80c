"""What an import kept: byte sums, coverage of required ids, forbidden fragments, outcomes, transports."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import basis_points

FRAGMENT_LIMIT = 256
FRAGMENT_BYTES = 16_384


def byte_metrics(artifacts: DataFrame, prefixes: dict[str, str], decided: bool = True) -> DataFrame:
    """One row: bytes under each path prefix, of each decision, and the reduction in basis points."""
    sums = [F.coalesce(F.sum(F.when(F.startswith("path", F.lit(p)), F.col("size_bytes"))), F.lit(0)).alias(f"{name}_bytes") for name, p in prefixes.items()]
    own = [F.coalesce(F.sum(F.when(F.col("decision") == d, F.col("size_bytes"))), F.lit(0)).alias(f"{d}_bytes") for d in ("keep", "extract", "tombstone", "reject")] if decided else []
    return artifacts.agg(*sums, *own, F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"))


def reduction(rows: DataFrame, before: str, after: str) -> DataFrame:
    """``rows`` with the reduction from one byte count to the other: basis points, rounded down, and whether assessed."""
    whole, left = F.col(before), F.col(after)
    return rows.withColumn("reduction_bp", basis_points(whole - left, whole)).withColumn("status", F.when(whole == 0, "unassessed").otherwise("assessed"))


def coverage(required: DataFrame, observed: DataFrame, key: str, group: str) -> DataFrame:
    """Per ``group`` of required keys: required, found, missing, basis points and status."""
    seen = observed.select(key).distinct().withColumn("_seen", F.lit(1))
    marked = required.select(group, key).distinct().join(seen, key, "left")
    n = marked.groupBy(group).agg(F.count("*").alias("required"), F.count("_seen").alias("found"))
    return n.withColumns(
        {"missing": F.col("required") - F.col("found"), "coverage_bp": basis_points(F.col("found"), F.col("required")), "status": F.when(F.col("found") == F.col("required"), "pass").otherwise("fail")}
    )


def forbidden_fragments(files: DataFrame, fragments: DataFrame) -> DataFrame:
    """fragment_id, n_files of fragments that some file's bytes contain, and of the rest with 0.

    ``files`` (path, content), ``fragments`` (fragment_id, fragment).  The fragments are a stated list of at most 256 of at
    most 16 KiB, which is checked; all of them are searched in one pass over each file's bytes.  Null contents and null
    fragments match nothing, empty fragments are refused."""
    listed, places = _listed(fragments)
    if not places:
        return fragments.select("fragment_id", F.lit(0).cast("bigint").alias("n_files"))
    found = files.select(F.col("content").cast("binary").alias("content")).mapInArrow(_search(places), "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    return _counted(found, fragments, listed)


def forbidden_fragments_in_windows(windows: DataFrame, fragments: DataFrame) -> DataFrame:
    """The same of files that come as overlapping windows (path, bytes; as ``windows.byte_windows`` and ``piece_windows`` give them), so
    that no file is held whole.  Windows overlap by ``FRAGMENT_BYTES`` at least; a file counts once a fragment."""
    listed, places = _listed(fragments)
    if not places:
        return fragments.select("fragment_id", F.lit(0).cast("bigint").alias("n_files"))
    each = windows.select(F.col("path").cast("string").alias("path"), "bytes").mapInArrow(_search_by_path(places), "path string, place int").distinct()
    return _counted(each.groupBy("place").agg(F.count("*").alias("n")), fragments, listed)


def _listed(fragments: DataFrame) -> tuple[list, dict[str, list[int]]]:
    """The stated list, and each fragment's bytes as Latin-1 with its places in the list."""
    listed = fragments.limit(FRAGMENT_LIMIT + 1).collect()
    if len(listed) > FRAGMENT_LIMIT or any(r["fragment"] is not None and not 0 < len(r["fragment"].encode()) <= FRAGMENT_BYTES for r in listed):
        raise ValueError("forbidden_fragment_limit")
    places: dict[str, list[int]] = {}
    for i, r in enumerate(listed):
        if r["fragment"] is not None:
            places.setdefault(r["fragment"].encode().decode("latin-1"), []).append(i)
    return listed, places


def _counted(found: DataFrame, fragments: DataFrame, listed: list) -> DataFrame:
    ids = F.array(*(F.lit(r["fragment_id"]) for r in listed))
    counted = found.select(F.get(ids, F.col("place")).alias("fragment_id"), "n").groupBy("fragment_id").agg(F.sum("n").alias("n"))
    return fragments.select("fragment_id").join(counted, "fragment_id", "left").select("fragment_id", F.coalesce("n", F.lit(0)).alias("n_files"))


def _automaton(places: dict[str, list[int]]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for fragment, own in places.items():
        automaton.add_word(fragment, own[0])
    automaton.make_automaton()
    return automaton


def _held(automaton, content: bytes, most: int) -> set[int]:
    """First places of the fragments that bytes, read as Latin-1, hold."""
    seen: set[int] = set()
    for _, first in automaton.iter(content.decode("latin-1")):
        seen.add(first)
        if len(seen) == most:
            break
    return seen


def _search_by_path(places: dict[str, list[int]]):
    """(path, place) of each fragment that a window holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, same = _automaton(places), {own[0]: own for own in places.values()}
        for batch in batches:
            found = {(path, i) for path, data in zip(batch.column("path").to_pylist(), batch.column("bytes")) if data.is_valid for first in _held(automaton, data.as_py(), len(same)) for i in same[first]}
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([i for _, i in found], pa.int32())], names=["path", "place"])

    return run


def _search(places: dict[str, list[int]]):
    """Counts, per batch of files, of those that hold each fragment; bytes are compared as Latin-1 characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, same = _automaton(places), {own[0]: own for own in places.values()}
        for batch in batches:
            counts: Counter[int] = Counter()
            for content in batch.column(0):
                if content.is_valid:
                    counts.update(i for first in _held(automaton, content.as_py(), len(same)) for i in same[first])
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["place", "n"])

    return run


def outcome_metric(outcomes: DataFrame, group: str) -> DataFrame:
    """Per ``group``: passed, failed, unverified, and basis points passed of those assessed."""
    n = outcomes.groupBy(group).agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("passed", "failed", "unverified")))
    return n.withColumn("score_bp", basis_points(F.col("passed"), F.col("passed") + F.col("failed")))


def route_check(routes: DataFrame) -> DataFrame:
    """route_id, sufficient, minimal of selected, required and justified role lists."""
    return routes.select(
        "route_id",
        (F.size(F.array_except("required", "selected")) == 0).alias("sufficient"),
        (F.size(F.array_except("selected", F.array_union("required", "justified"))) == 0).alias("minimal"),
    )


def transports_agree(objects: DataFrame) -> DataFrame:
    """trial_id, profiles, equivalent: whether every profile carries the same objects with the same bytes.

    Compared by counts of (object, bytes) over profiles, so no profile's list is gathered."""
    n = objects.groupBy("trial_id").agg(F.countDistinct("profile").alias("profiles"))
    uneven = objects.distinct().groupBy("trial_id", "object_id", "sha256").agg(F.countDistinct("profile").alias("in_profiles")).join(n, "trial_id").where("in_profiles <> profiles").select("trial_id").distinct().withColumn("_uneven", F.lit(True))
    return n.join(uneven, "trial_id", "left").select("trial_id", "profiles", F.col("_uneven").isNull().alias("equivalent"))
