"""Checks of what an import says about itself: records, artifact lists, transported objects, counts, ids, statuses.

Each check returns its offenders as (code, subject), or one small row per metric; ``members.require_none`` raises the first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.constants import ADAPTER_PROTOCOL, CONVERSATION_PROTOCOL, MESSAGE_PROTOCOL
from ledgerloom.functions.text import basis_points, is_hex_sha256, is_sha256_reference, is_unsafe_path, normalized_path
from ledgerloom.operators.members import DECISIONS
from ledgerloom.operators.review import out_of_order
from ledgerloom.sources.checkpoints import written

# Limits and names of artifact lists and transported objects.
MAX_ARTIFACTS = 100_000
MAX_OBJECT_BYTES = 2_147_483_648
RESERVED_PATHS = ("CANDIDATE.json", "IMPORT.json", "SHA256SUMS")


def _record_violations(records: DataFrame, code: str, protocol: str, adapter_id: str, *more: Column) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    broken = [
        ~F.col("protocol").eqNullSafe(protocol), ~F.col("adapter_protocol").eqNullSafe(ADAPTER_PROTOCOL), ~F.col("adapter_id").eqNullSafe(adapter_id),
        blank("source_vendor"), blank("source_type"), F.coalesce(F.col("source_index") < 0, F.lit(True)), *more,
    ]
    subject = F.concat_ws(":", "source_path", F.col("source_index").cast("string"))
    return records.where(reduce(lambda a, b: a | b, broken)).select(F.lit(code).alias("code"), subject.alias("subject"))


def record_violations(conversations: DataFrame, messages: DataFrame, adapter_id: str, placed: bool = True) -> DataFrame:
    """code, subject of canonical records that break their contract: fixed protocols, the adapter's own id, vendor, type
    and (where ``placed``) path that are not empty, indexes from 0 on, texts and lists that are not null, references that don't repeat."""
    path = [F.coalesce(F.col("source_path") == "", F.lit(True))] if placed else []
    null_in = lambda c: F.coalesce(F.exists(c, lambda v: v.isNull()), F.lit(True))
    repeats = F.size(F.array_distinct("attachment_refs")) != F.size("attachment_refs")
    said = _record_violations(messages, "invalid_message_record", MESSAGE_PROTOCOL, adapter_id, F.col("text").isNull(), null_in("source_children_ids"), null_in("attachment_refs"), repeats, *path)
    return _record_violations(conversations, "invalid_conversation_record", CONVERSATION_PROTOCOL, adapter_id, *path).unionByName(said)


def artifact_violations(artifacts: DataFrame) -> DataFrame:
    """code, subject of a list of ``artifacts`` (position, path, sha256, size_bytes) that is no sorted list of safe, unreserved
    paths with their digests and sizes.  Order is by the bytes of paths and is checked over ranges of positions."""
    path = F.col("path")
    single = (
        F.when(path.isNull() | is_unsafe_path(path) | (normalized_path(path) != path), "invalid_path")
        .when(path.isin(list(RESERVED_PATHS)), "reserved_artifact_path")
        .when(~is_hex_sha256(F.col("sha256")), "invalid_sha256")
        .when(F.coalesce(F.col("size_bytes") < 0, F.lit(True)), "invalid_size")
    )
    each = artifacts.select(single.alias("code"), path.alias("subject")).where("code is not null")
    unsorted = out_of_order(artifacts.select("position", "path", F.lit(0).alias("list")), "position", "path", "list")
    unsorted = unsorted.select(F.lit("artifact_order").alias("code"), F.col("path").alias("subject"))
    repeated = artifacts.groupBy("path").count().where("count > 1").select(F.lit("duplicate_artifact").alias("code"), F.col("path").alias("subject"))
    many = artifacts.agg(F.count("*").alias("n")).where(F.col("n") > MAX_ARTIFACTS).select(F.lit("invalid_artifacts").alias("code"), F.lit("*").alias("subject"))
    return each.unionByName(unsorted).unionByName(repeated).unionByName(many)


def object_violations(objects: DataFrame) -> DataFrame:
    """code, subject of transported ``objects`` (object_id, bytes_sha256, size_bytes) whose id is no digest, is not that of their bytes, or whose size is out of bounds."""
    code = (
        F.when(~is_sha256_reference(F.col("object_id")), "transport_object_id")
        .when(~F.col("bytes_sha256").eqNullSafe(F.col("object_id")), "transport_object_hash")
        .when(F.coalesce((F.col("size_bytes") < 0) | (F.col("size_bytes") > MAX_OBJECT_BYTES), F.lit(True)), "transport_object_size")
    )
    return objects.select(code.alias("code"), F.col("object_id").alias("subject")).where("code is not null")


def reconciled_counts(decided: DataFrame, receipt: DataFrame) -> DataFrame:
    """metric, expected, found, status of every count of ``receipt`` (metric, expected) against ``decided`` (path, decision):
    files_seen, files_<decision>, and paths or decisions that can't be, as files_duplicate and files_undecided."""
    per_path = decided.groupBy("path", "decision").agg(F.count("*").alias("n"))
    known = F.col("decision").isin(list(DECISIONS))
    one = per_path.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("files_seen"),
        *(F.coalesce(F.sum(F.when(F.col("decision") == d, F.col("n"))), F.lit(0)).alias(f"files_{d}") for d in DECISIONS),
        F.coalesce(F.sum(F.when(~F.coalesce(known, F.lit(False)), F.col("n"))), F.lit(0)).alias("files_undecided"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.countDistinct("path")).alias("files_duplicate"),
    )
    names = ["files_seen", *(f"files_{d}" for d in DECISIONS), "files_undecided", "files_duplicate"]
    found = one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("found")) for n in names))).alias("m")).select("m.*")
    status = F.when(F.coalesce("expected", F.lit(0)) == F.col("found"), "pass").otherwise("fail")
    return found.join(receipt, "metric", "left").select("metric", F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"), "found", status.alias("status"))


def candidate_conversation_id(source: Column, own: Column, nested_id: Column, nested_own: Column) -> Column:
    """The conversation that a record of either family names: flat ids where not empty, else those of the nested object."""
    empty = F.lit("")
    return F.coalesce(F.nullif(source, empty), F.nullif(own, empty), nested_id, nested_own)


def candidate_message_id(source: Column, nested_id: Column) -> Column:
    """The message that a record of either family names."""
    return F.coalesce(source, nested_id)


def observed_ids(conversations: DataFrame, messages: DataFrame, tombstones: DataFrame) -> DataFrame:
    """component, id, distinct: conversations (conversation_id), messages (message_id, attachment_refs), and references of
    messages and ``tombstones`` (reference_key, reference_keys)."""
    talks = conversations.select(F.lit("conversations").alias("component"), F.col("conversation_id").alias("id"))
    said = messages.select(F.lit("messages").alias("component"), F.col("message_id").alias("id"))
    refs = messages.select(F.explode("attachment_refs").alias("id")).unionByName(
        tombstones.select(F.explode(F.concat(F.array("reference_key"), F.coalesce("reference_keys", F.array().cast("array<string>")))).alias("id"))
    )
    refs = refs.where("id <> ''").select(F.lit("attachments").alias("component"), "id")
    return talks.unionByName(said).unionByName(refs).where("id is not null").distinct()


def component_coverage(required: DataFrame, observed: DataFrame, components: tuple[str, ...]) -> DataFrame:
    """component, required, found, coverage_bp, status of every component: ``required`` and ``observed`` are (component, id);
    a component that requires nothing is unassessed."""
    names = required.sparkSession.createDataFrame([(c,) for c in components], "component string")
    seen = observed.select("component", "id").distinct().withColumn("__seen", F.lit(1))
    n = required.select("component", "id").distinct().join(seen, ["component", "id"], "left").groupBy("component").agg(F.count("*").alias("required"), F.count("__seen").alias("found"))
    whole, found = F.coalesce("required", F.lit(0)), F.coalesce("found", F.lit(0))
    status = F.when(whole == 0, "unassessed").when(whole == found, "pass").otherwise("fail")
    return names.join(n, "component", "left").select("component", whole.alias("required"), found.alias("found"), basis_points(found, whole).alias("coverage_bp"), status.alias("status"))


def overall_status(components: DataFrame, group: str | None = None) -> DataFrame:
    """status of all ``components`` (status), or of each ``group``: fail before pass before unassessed; nothing at all is unassessed."""
    any_ = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    status = F.when(any_("fail"), "fail").when(any_("pass"), "pass").otherwise("unassessed").alias("status")
    return (components.groupBy(group) if group else components).agg(status)


def conforms(metrics: DataFrame, group: str) -> DataFrame:
    """group, conforms of ``metrics`` (group, status, forbidden_found): no metric failed and nothing forbidden was found."""
    bad = F.bool_or((F.col("status") == "fail") | F.coalesce("forbidden_found", F.lit(False)))
    return metrics.groupBy(group).agg((~F.coalesce(bad, F.lit(False))).alias("conforms"))


def listed_inputs(inputs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """code, subject of ``inputs`` (path) that ``artifacts`` (path) does not list."""
    return inputs.select("path").distinct().join(artifacts.select("path"), "path", "left_anti").select(F.lit("candidate_artifact_missing").alias("code"), F.col("path").alias("subject"))


PIECE = 1 << 20


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range, in order, as numbered pieces of some MiB."""
    held, size, n, rows = [], 0, 0, 0
    part = TaskContext.get().partitionId()

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in ((part, pa.int32()), (n, pa.int32()), (rows, pa.int64()), (b",".join(held), pa.binary()))], names=["part", "nth", "n", "bytes"])

    for batch in batches:
        for text in batch.column(0):
            own = text.as_py().encode()
            held.append(own)
            size, rows = size + len(own), rows + 1
            if size >= PIECE:
                yield piece()
                held, size, n, rows = [], 0, n + 1, 0
    if held:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of all pieces, read in order."""
    digest, total, between = hashlib.sha256(b"["), 0, b""
    for batch in batches:
        for n, data in zip(batch.column("n").to_pylist(), batch.column("bytes")):
            if not data.is_valid:
                continue
            digest.update(between)
            digest.update(data.as_buffer())
            total, between = total + n, b","
    digest.update(b"]\n")
    yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["n", "sha256"])


def tree_digest(artifacts: DataFrame) -> DataFrame:
    """One row: n, sha256 of the canonical JSON of ``artifacts`` (path, sha256, size_bytes), sorted by path.

    Rows are dealt to ranges of paths and written as pieces in order.  A digest goes through its bytes one after the other, so its last
    step is one task; it reads piece by piece and holds one of them at a time."""
    row = F.concat(F.lit('{"path":'), _json_string(F.col("path")), F.lit(',"sha256":"'), "sha256", F.lit('","size_bytes":'), F.col("size_bytes").cast("string"), F.lit("}"))
    keyed = artifacts.select(F.encode("path", "UTF-8").alias("key"), row.alias("json"))
    dealt = keyed.repartitionByRange("key", "json").sortWithinPartitions("key", "json").select("json")
    pieces = written(dealt.mapInArrow(_cut, "part int, nth int, n bigint, bytes binary"), "digest-pieces")
    # an empty list has a digest too: a piece without bytes stands before all others
    first = artifacts.sparkSession.range(1).select(F.lit(-1).alias("part"), F.lit(0).alias("nth"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("binary").alias("bytes"))
    return pieces.unionByName(first).repartition(1).sortWithinPartitions("part", "nth").select("n", "bytes").mapInArrow(_hashed, "n bigint, sha256 string")


def _json_string(text: Column) -> Column:
    """A string as JSON writes it: what ``to_json`` puts after the key of a one-field struct."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), '(?s)^\\{"v":(.*)\\}$', 1)
