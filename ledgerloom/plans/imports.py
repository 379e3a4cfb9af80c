"""The import of an export: members in, canonical tables, dispositions and findings out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.classification import Policy
from ledgerloom.functions.privacy import findings
from ledgerloom.functions.text import basename, reference_ids
from ledgerloom.operators.conformance import record_violations
from ledgerloom.operators.members import counters, provenance, require_none, violations, with_disposition
from ledgerloom.operators.messages import conversation_order, message_order
from ledgerloom.operators.windows import piece_windows, window_findings
from ledgerloom.operators.references import attachment_index, described_by_any_key, described_by_one_key
from ledgerloom.plans.adapters import IDENTITIES, conversation_strings, discovered, parse
from ledgerloom.plans.checks import discovery_violations, payload_violations
from ledgerloom.plans.registry import Adapter, adapter, checked_override, register
from ledgerloom.plans.documents import DocumentPolicy, document_texts, retained, settled_documents
from ledgerloom.plans.outputs import Store, commit, retain
from ledgerloom.sources.checkpoints import written
from ledgerloom.sources.json_rows import allowed_fields, is_strict_json, json_text
from ledgerloom.sources.tree import read_tree

# Members that an adapter decides on by name, as (pattern, decision, reason).
OVERRIDES = {
    "grok": [
        ("(^|/)(prod-mc-auth-mgmt-api|prod-mc-billing)\\.json$", "reject", "xai_sensitive_account_source"),
        ("(^|/)(prod-mc-asset-server|canvas_thumbnails)(/|$)", "tombstone", "xai_binary_asset_policy"),
    ],
    "claude": [("(?i)(^|/)(users|user|account)\\.json$", "reject", "claude_account_metadata_out_of_scope")],
    "github": [
        ("(?i)(^|/)attachments(/|$)", "tombstone", "github_attachment_payload"),
        ("(?i)(^|/)repositories(/|$)", "reject", "github_git_payload_out_of_scope"),
    ],
}


def override(path: Column, name: str) -> Column | None:
    """The adapter's own decision for a path, or null."""
    out = None
    for pattern, decision, reason in OVERRIDES.get(name, []):
        fits, decided = F.rlike(path, F.lit(pattern)), F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))
        out = F.when(fits, decided) if out is None else out.when(fits, decided)
    return out


def grok_reference(path: Column) -> Column:
    """The asset directory's name, or the stem of a thumbnail; null elsewhere."""
    asset = F.nullif(F.regexp_extract(path, "(?:^|/)prod-mc-asset-server/([^/]+)", 1), F.lit(""))
    return F.coalesce(asset, F.when(F.rlike(path, F.lit("(^|/)canvas_thumbnails/")), F.regexp_replace(basename(path), "(?<=.)\\.[^.]*$", "")))


def reference_key(path: Column, name: str) -> Column:
    """The one key under which an adapter's messages refer to a member."""
    if name == "grok":
        return grok_reference(path)
    if name == "openai-common":
        return F.coalesce(F.get(F.array_sort(F.transform(reference_ids(path), lambda k: F.regexp_replace(k, "^id:", ""))), 0), F.lower(basename(path)))
    return basename(path)


def _registered(name: str) -> Adapter:
    """One of the vendors' adapters."""
    return register(
        Adapter(
            name, *IDENTITIES[name], discover=lambda m: discovered(m, name), parse=lambda p: parse(p, name), discovery_violations=lambda m: discovery_violations(m, name),
            payload_violations=lambda p: payload_violations(p, name), override=lambda path: override(path, name), reference_key=lambda path: reference_key(path, name),
            contexts=conversation_strings if name == "openai" else None,
        )
    )


for _name in IDENTITIES:
    _registered(_name)


def tombstones(dropped: DataFrame, payloads: DataFrame, messages: DataFrame, name: str) -> DataFrame:
    """``dropped`` members (path, kind) with what refers to them: conversations whose strings hold any of a member's keys,
    or, by adapters with one key a member, messages whose attachments have that key."""
    own = adapter(name)
    if own.contexts is not None:
        return described_by_any_key(dropped, attachment_index(own.contexts(payloads)))
    index = messages.select(F.explode("attachment_refs").alias("ref_key"), "source_path", "source_index", "conversation_id", "source_message_id")
    return described_by_one_key(dropped.withColumn("ref_key", own.reference_key(F.col("path"))), index)


@dataclass(frozen=True)
class Limits:
    max_entries: int = 100_000
    max_member: int = 2_147_483_648
    max_total: int = 68_719_476_736
    max_ratio: float = 500.0
    max_conversation: int = 268_435_456


@dataclass(frozen=True)
class Import:
    """Lazy tables of one import."""

    conversations: DataFrame
    messages: DataFrame
    members: DataFrame
    tombstones: DataFrame
    provenance: DataFrame
    findings: DataFrame
    documents: DataFrame
    retained: DataFrame

    def statistics(self) -> DataFrame:
        """One row of counters."""
        return (
            counters(self.members)
            .crossJoin(self.conversations.agg(F.count("*").alias("conversations")))
            .crossJoin(self.messages.agg(F.count("*").alias("messages")))
            .crossJoin(self.findings.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("privacy_findings")))
        )


def account_metadata(members: DataFrame, allowed: dict[str, list[str]], max_bytes: int = 1_048_576) -> DataFrame:
    """path, kept: the allowed top-level fields of the members named exactly, where they are strict JSON of bounded size."""
    raw = members.where(F.col("path").isin(list(allowed)) & (F.col("size_bytes") <= max_bytes)).select("path", json_text(F.col("content")).alias("raw"))
    kept = F.lit(None).cast("string")
    for path, fields in allowed.items():
        kept = F.when(F.col("path") == path, allowed_fields(F.col("raw"), fields)).otherwise(kept)
    return raw.where(is_strict_json(F.col("raw"))).select("path", kept.alias("kept"))


def _not_read(decided: DataFrame) -> DataFrame:
    """Kept text members that are too large for their row."""
    return decided.where("decision = 'keep' and kind = 'structured_text' and content is null and size_bytes > 0").select("source", "path")


def import_members(members: DataFrame, name: str, policy: Policy = Policy(), limits: Limits = Limits(), pieces: DataFrame | None = None, document_policy: DocumentPolicy = DocumentPolicy()) -> Import:
    """Tables of ``members`` (source, path, size_bytes, compressed_bytes, is_link, head, sha256, content, problem) by the adapter of that name.

    Guards on members come first, then on what the adapter finds, then on what it must parse; an offender raises its code
    before anything is written to an output, and no payload, line, conversation or record that can't be read is passed over.
    Members are written to the shared folder first, so that each archive is opened once and later passes read the columns they need.
    Texts that are too large for a row are searched in their ``pieces`` (``archives.read_archives``); without them such a member
    is refused."""
    own = adapter(name)
    members = written(members, "members")
    broken = members.where("problem is not null or is_link").select(F.coalesce("problem", F.lit("symlink_member")).alias("code"), F.col("path").alias("subject"))
    require_none(broken.unionByName(violations(members, limits.max_entries, limits.max_member, limits.max_total, limits.max_ratio)))
    require_none(own.discovery_violations(members))
    found = own.discover(members)
    require_none(found.where(F.col("size_bytes") > limits.max_conversation).select(F.lit("conversation_member_limit").alias("code"), F.col("path").alias("subject")))
    payloads = found.select(F.col("path").alias("source_path"), json_text(F.col("content")).alias("raw"))
    require_none(own.payload_violations(payloads))
    conversations, messages = own.parse(payloads)
    require_none(record_violations(conversations, messages, own.adapter_id, placed=own.placed))
    rest = members.join(found.select("path"), "path", "left_anti")
    decided = with_disposition(rest, policy, checked_override(rest, own))
    # only documents have text to extract
    require_none(decided.where("decision = 'extract' and kind <> 'document'").select(F.lit("unsupported_extract_kind").alias("code"), F.col("path").alias("subject")))
    documents = document_texts(decided, document_policy)
    decided = settled_documents(decided, documents, document_policy)
    dropped = decided.where("decision = 'tombstone'").select("path", "kind", "media_type", "size_bytes", "sha256", "reason")
    consumed = found.withColumns({"decision": F.lit("normalized"), "reason": F.lit("adapter_payload")})
    columns = ["path", "sha256", "size_bytes", "decision", "reason"]
    everything = decided.select(columns).unionByName(consumed.select(columns))
    texts = messages.select(F.concat_ws("/", F.lit("messages"), "conversation_id", "source_message_id").alias("path"), "text")
    kept_text = decided.where("decision = 'keep' and kind = 'structured_text'").select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    scanned, large = findings(texts.unionByName(kept_text).unionByName(documents.where("text is not null").select("path", "text"))), _not_read(decided)
    unread = large if pieces is None else large.join(pieces.select("source", "path"), ["source", "path"], "left_anti")
    require_none(unread.select(F.lit("unscanned_member").alias("code"), F.col("path").alias("subject")))
    if pieces is not None:
        scanned = scanned.unionByName(window_findings(piece_windows(pieces.join(large, ["source", "path"], "left_semi"))))
    return Import(
        conversations, messages, decided.drop("content"), tombstones(dropped, payloads, messages, name), provenance(everything, *own.identity),
        scanned, documents.where("problem is null"), retained(decided, document_policy).select("source", "path", "size_bytes", "sha256", "content"),
    )


def canonical_lines(rows: DataFrame) -> DataFrame:
    """Rows as JSON with sorted keys, nulls kept and control characters in lower-case escapes."""
    text = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    for digit in "ABCDEF":
        text = F.regexp_replace(text, f"(?<!\\\\)((?:\\\\\\\\)*)\\\\u00([01]){digit}", f"$1\\\\u00$2{digit.lower()}")
    return rows.select(text.alias("value"))


def write_import(result: Import, output: str, replace: bool = False, unchanged: DataFrame | None = None) -> None:
    """Write the tables and retained files beside ``output`` and move them there, so that readers see all of them or none.

    JSON lines are range-partitioned by their canonical order: the part files, in name order, are the ordered whole.  An
    output that is there is refused unless ``replace``; then it is swapped, and stays if anything fails before.  ``unchanged`` (code,
    subject) is asked last, as by ``tree.changed`` of listings before and now: an offender ends the import."""
    spark: SparkSession = result.messages.sparkSession
    staging, store = f"{output.rstrip('/')}.staging-{uuid.uuid4().hex}", Store(spark, output)
    if store.exists(output) and not replace:
        raise FileExistsError(output)
    try:
        canonical_lines(result.conversations.orderBy(*conversation_order())).write.text(f"{staging}/conversations")
        canonical_lines(result.messages.orderBy(*message_order())).write.text(f"{staging}/messages")
        canonical_lines(result.provenance.orderBy("source_path")).write.text(f"{staging}/provenance")
        canonical_lines(result.tombstones.orderBy("path")).write.text(f"{staging}/tombstones")
        result.documents.write.parquet(f"{staging}/extracted")
        result.findings.write.parquet(f"{staging}/reports/privacy")
        result.members.write.parquet(f"{staging}/reports/classifications")
        result.statistics().write.json(f"{staging}/reports/statistics")
        retain(result.retained, f"{staging}/retained").write.parquet(f"{staging}/reports/retained")
        manifest = read_tree(spark, staging).where(~F.rlike("path", F.lit("(^|/)[_.][^/]*$"))).orderBy("path")
        manifest.select(F.concat_ws("  ", "sha256", "path").alias("value")).write.text(f"{staging}/manifest")
        if unchanged is not None:
            require_none(unchanged)
        commit(store, staging, output, replace)
    except Exception:
        store.delete(staging)
        raise
