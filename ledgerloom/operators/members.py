"""Members of a source: limits, dispositions, identities, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.constants import ADAPTER_PROTOCOL, PROVENANCE_PROTOCOL
from ledgerloom.functions.classification import Policy, classified, disposition
from ledgerloom.functions.text import extension, is_unsafe_path, normalized_path
from ledgerloom.operators.ordered import running_sum

DECISIONS = ("keep", "extract", "tombstone", "reject")


class RuleViolation(ValueError):
    """A rule that must have no offenders has some; ``code`` names the rule."""

    def __init__(self, code: str, subject: str):
        super().__init__(f"{code}: {subject}")
        self.code = code


def with_disposition(members: DataFrame, policy: Policy = Policy(), override: Column | None = None) -> DataFrame:
    """``members`` (path, size_bytes, head) with kind, media_type, decision and reason.  ``override`` is a struct of
    decision and reason, null where the policy decides."""
    ext = extension(F.col("path"))
    kinds = members.withColumn("_c", classified(F.col("head"), ext)).withColumns({"kind": F.col("_c.kind"), "media_type": F.col("_c.media_type")}).drop("_c")
    decided = disposition(F.col("kind"), F.col("size_bytes"), policy)
    decided = decided if override is None else F.coalesce(override, decided)
    return kinds.withColumn("_d", decided).withColumns({"decision": F.col("_d.decision"), "reason": F.col("_d.reason")}).drop("_d")


def counters(decided: DataFrame) -> DataFrame:
    """One row: how many members each decision has, and how many there are."""
    return decided.agg(*(F.count_if(F.col("decision") == d).alias(f"files_{d}") for d in DECISIONS), F.count("*").alias("files_seen"))


def artifact_identity(files: DataFrame) -> DataFrame:
    """path, sha256, size_bytes of ``files`` (path, content)."""
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("size_bytes"))


def duplicates(artifacts: DataFrame) -> DataFrame:
    """sha256, copies, first_path of contents that occur more than once."""
    return artifacts.groupBy("sha256").agg(F.count("*").alias("copies"), F.min("path").alias("first_path")).where("copies > 1")


def path_collisions(paths: DataFrame) -> DataFrame:
    """normalized, paths of different spellings of one path."""
    return paths.select(normalized_path(F.col("path")).alias("normalized"), "path").groupBy("normalized").agg(F.count("*").alias("n_paths")).where("n_paths > 1")


def violations(members: DataFrame, max_entries: int, max_member: int, max_total: int, max_ratio: float) -> DataFrame:
    """code, subject of every broken limit or unsafe name of ``members`` (path, size_bytes, compressed_bytes), in one pass
    and one small aggregate."""
    ratio = F.col("size_bytes") / F.nullif(F.col("compressed_bytes"), F.lit(0))
    single = (
        F.when(is_unsafe_path(F.col("path")), "unsafe_path")
        .when(F.col("size_bytes") > max_member, "source_member_limit")
        .when(ratio > max_ratio, "source_compression_ratio")
    )
    each = members.select(single.alias("code"), F.col("path").alias("subject")).where("code is not null")
    repeated = members.groupBy("path").count().where("count > 1").select(F.lit("duplicate_member").alias("code"), F.col("path").alias("subject"))
    collided = path_collisions(members.select("path").distinct()).select(F.lit("path_collision").alias("code"), F.col("normalized").alias("subject"))
    totals = members.agg(F.count("*").alias("n"), F.sum("size_bytes").alias("total"))
    whole = totals.select(F.when(F.col("n") > max_entries, "source_entry_limit").when(F.col("total") > max_total, "source_total_limit").alias("code"), F.lit("*").alias("subject")).where("code is not null")
    return each.unionByName(repeated).unionByName(collided).unionByName(whole)


def require_none(rows: DataFrame) -> None:
    """Raise for the first offender by code and subject; one row reaches the driver."""
    for row in rows.orderBy("code", "subject").limit(1).collect():
        raise RuleViolation(row["code"], row["subject"])


def running_total_excess(members: DataFrame, order: str, limit: int, group: str) -> DataFrame:
    """Members of each ``group`` at which its running size passes ``limit``; the group may be larger than a task."""
    return running_sum(members, group, order, "size_bytes", "running_bytes").where(F.col("running_bytes") > limit)


def provenance(decided: DataFrame, adapter_id: str, vendor: str, source_type: str) -> DataFrame:
    """One row for every member: where it came from and what became of it.  Consumed members are ``normalized``."""
    fixed = {"protocol": PROVENANCE_PROTOCOL, "adapter_protocol": ADAPTER_PROTOCOL, "adapter_id": adapter_id, "source_vendor": vendor, "source_type": source_type}
    return decided.select(
        *(F.lit(v).alias(k) for k, v in fixed.items()), F.col("path").alias("source_path"), F.col("sha256").alias("source_sha256"), "size_bytes",
        F.col("decision").alias("disposition"), "reason",
    )
