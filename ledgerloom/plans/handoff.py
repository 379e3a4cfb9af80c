"""An import as a candidate: its manifest, the check of a candidate against its files, and the staging of what a decision accepts."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import is_unsafe_path
from ledgerloom.operators.conformance import tree_digest
from ledgerloom.operators.members import require_none
from ledgerloom.operators.review import decision_coverage, decision_summary, split_by_decision
from ledgerloom.plans.outputs import STORED, Store, _copied, commit
from ledgerloom.sources.archives import opened
from ledgerloom.sources.checkpoints import written
from ledgerloom.sources.tree import read_tree

# What a staged entry may be classed as.
PRIVACY_CLASSES = ("PUBLIC", "INTERNAL", "RESTRICTED")
RECOVERY_CLASSES = ("NEAR_SHELL", "MID_SHELL", "OUTER_SHELL", "RESONANCE_NODE", "WIGGLE_ZONE")
# The review records of a candidate.
REVIEW = ("candidate", "manifest")


def artifacts_of(spark: SparkSession, root: str) -> DataFrame:
    """path, sha256, size_bytes of the files of a candidate, but for its review records and names that begin with _ or . ."""
    hidden = F.rlike("path", F.lit("(^|/)[_.][^/]*$"))
    return read_tree(spark, root).where(~hidden & ~F.split("path", "/")[0].isin(*REVIEW))


def candidate_manifest(artifacts: DataFrame, **fields: str) -> DataFrame:
    """One row: ``fields``, the number of ``artifacts`` and their bytes, and the digest of their ordered list."""
    whole = artifacts.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"))
    both = tree_digest(artifacts).withColumnsRenamed({"n": "artifacts", "sha256": "artifacts_sha256"}).crossJoin(whole)  # one row each
    return both.select(*(F.lit(v).alias(k) for k, v in sorted(fields.items())), "artifacts", "total_bytes", "artifacts_sha256")


def artifact_violations(declared: DataFrame, found: DataFrame, key: str = "path") -> DataFrame:
    """code, subject where the files that were ``found`` (key, sha256, size_bytes) are not those ``declared``: missing or unexpected,
    of another size, or of another hash."""
    names = {"path": ("candidate_tree_mismatch", "artifact_size_mismatch", "artifact_hash_mismatch"), "object_id": ("object_inventory_mismatch", "object_size_mismatch", "object_hash_mismatch")}[key]
    there = found.select(F.col(key).alias("_key"), F.col("sha256").alias("_sha256"), F.col("size_bytes").alias("_size"))
    both = declared.select(key, "sha256", "size_bytes").join(there, F.col(key) == F.col("_key"), "full_outer")
    code = (
        F.when(F.col(key).isNull() | F.col("_key").isNull(), names[0]).when(~F.col("size_bytes").eqNullSafe(F.col("_size")), names[1])
        .when(~F.col("sha256").eqNullSafe(F.col("_sha256")), names[2])
    )
    return both.select(code.alias("code"), F.coalesce(key, "_key").alias("subject")).where("code is not null")


def copied(files: DataFrame, root: str, folder: str) -> DataFrame:
    """Copy ``files`` (path, staged_path, sha256) from ``root`` to ``folder``, each hashed as it streams; path, stored_path, size_bytes, sha256."""
    safe = F.when(is_unsafe_path(F.col("staged_path")), F.raise_error(F.concat(F.lit("unsafe_path: "), "staged_path"))).otherwise(F.col("staged_path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, start), (store, end) = opened(root), opened(folder)
        for batch in batches:
            done = []
            for path, staged, expected in zip(*(batch.column(c).to_pylist() for c in ("path", "staged_path", "sha256"))):
                with source.open_input_stream(f"{start.rstrip('/')}/{path}") as stream:
                    size, digest = _copied(stream, store, f"{end.rstrip('/')}/{staged}")
                if digest != expected:
                    raise ValueError(f"artifact_hash_mismatch: {path}")
                done.append((path, staged, size, digest))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=[c.split(" ")[0] for c in STORED.split(", ")])

    return files.select("path", safe.alias("staged_path"), "sha256").mapInArrow(run, STORED)


def pack_entries(accepted: DataFrame, privacy_class: str, recovery_class: str, decision_id: str) -> DataFrame:
    """logical_path, source_path, kind, privacy_class, recovery_class, source_ref of ``accepted`` (path, staged_path), by logical path."""
    return accepted.select(
        F.concat(F.lit("import-candidate/artifacts/"), "path").alias("logical_path"), F.col("staged_path").alias("source_path"), F.lit("candidate-artifact").alias("kind"),
        F.lit(privacy_class).alias("privacy_class"), F.lit(recovery_class).alias("recovery_class"), F.concat(F.lit(f"import-decision:{decision_id}#"), "path").alias("source_ref"),
    ).orderBy(F.encode("logical_path", "UTF-8"))


def stage(
    declared: DataFrame, decisions: DataFrame, root: str, output: str, privacy_class: str = "RESTRICTED", recovery_class: str = "OUTER_SHELL", replace: bool = False
) -> None:
    """Stage what ``decisions`` (path, disposition, reason) accept of the candidate at ``root``: ``output`` gets ``accepted/`` with the files,
    and as tables the entries to pack, the decided artifacts and the summary.

    ``declared`` (path, sha256, size_bytes) must be the candidate's files, each decided once; offenders raise their code and ``output``
    stays as it was.  Files are copied and hashed by the tasks; the tree appears at once or not at all."""
    if privacy_class not in PRIVACY_CLASSES:
        raise ValueError("privacy_class")
    if recovery_class not in RECOVERY_CLASSES:
        raise ValueError("recovery_class")
    spark = declared.sparkSession
    require_none(artifact_violations(declared, artifacts_of(spark, root)))
    decided = written(decisions.select("path", "disposition", "reason"), "decisions")
    require_none(decision_coverage(declared, decided, "path").select(F.col("problem").alias("code"), F.col("path").alias("subject")))
    wrong = decided.where(~F.coalesce(F.col("disposition").isin("accept", "reject"), F.lit(False)))
    require_none(wrong.select(F.lit("invalid_disposition").alias("code"), F.col("path").alias("subject")))
    split = split_by_decision(declared, decided, "path").join(decided.select("path", "reason"), "path")
    store, staging = Store(spark, output), f"{output.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        files = split.where("disposition = 'accept'")
        copied(files, root, staging).write.parquet(f"{staging}/review/copied")
        identity = hashlib.sha256(tree_digest(files.select("path", "sha256", "size_bytes")).first()["sha256"].encode()).hexdigest()
        pack_entries(files, privacy_class, recovery_class, identity).write.json(f"{staging}/pack")
        split.select("path", "sha256", "size_bytes", "disposition", "reason").orderBy("path").write.json(f"{staging}/review/decided")
        decision_summary(decided).write.json(f"{staging}/review/summary")
        commit(store, staging, output, replace)
    except Exception:
        store.delete(staging)
        raise
