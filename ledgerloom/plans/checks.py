"""What payloads and discovered members must be before they are parsed: offenders by code, so that nothing vanishes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.adapters import ISSUE_LISTS, VENDORS, by_kind, discovered, kind, value
from ledgerloom.sources.json_rows import elements, is_strict_json, numbered_lines

# The codes of each adapter, as (members found, payload that is no strict JSON, payload of an unknown shape).
CODES = {
    "openai": ("openai_conversation_discovery", "invalid_json", "unsupported_openai_shape"),
    "openai-common": ("openai_conversation_discovery", "invalid_json", "unsupported_openai_shape"),
    "grok": ("grok_backend_cardinality", "invalid_grok_backend_json", "invalid_grok_conversations"),
    "claude": ("claude_conversation_cardinality", "invalid_claude_json", "unsupported_claude_shape"),
    "gemini": ("gemini_source_cardinality", "invalid_gemini_json", "unsupported_gemini_shape"),
    "generic": ("generic_source_cardinality", "invalid_json", "unsupported_generic_shape"),
    "github": ("github_resource_discovery", "invalid_github_json", "invalid_github_resource_shape"),
}
#: Adapters that read any number of members, one at least; the others read exactly one.
MANY = ("openai", "openai-common", "github")
THREAD_RESOURCE = "(?i)(^|/)(issues|pull_requests)[^/]*$"


def discovery_violations(members: DataFrame, adapter: str) -> DataFrame:
    """code, subject where ``members`` (path) hold too few or too many members for the adapter; one row to the aggregate."""
    n = discovered(members, adapter).agg(F.count("*").alias("n"), F.count_if(F.rlike("path", F.lit(THREAD_RESOURCE))).alias("threads"))
    wrong = F.col("n") < 1 if adapter in MANY else F.col("n") != 1
    code = F.when(wrong, CODES[adapter][0])
    if adapter == "github":
        code = code.when(F.col("threads") < 1, "github_thread_discovery")
    return n.select(code.alias("code"), F.concat(F.lit("found "), F.col("n").cast("string")).alias("subject")).where("code is not null")


def _is(v: Column, name: str) -> Column:
    return F.coalesce(F.startswith(kind(v), F.lit(name)), F.lit(False))


def _lists(adapter: str) -> tuple[str, ...]:
    return ISSUE_LISTS if adapter == "github" else ("conversations",)


def _place(*parts: str) -> Column:
    return F.concat_ws(":", "source_path", *(F.col(p).cast("string") for p in parts))


def _found(rows: DataFrame, code: Column, *parts: str) -> DataFrame:
    return rows.select(code.alias("code"), _place(*parts).alias("subject")).where("code is not null")


def payload_violations(payloads: DataFrame, adapter: str) -> DataFrame:
    """code, subject of every payload of ``payloads`` (source_path, raw), of its lines, conversations and messages that
    the adapter can't read.  Subjects are paths, with the line from 1 on or the indexes from 0 on."""
    _, no_json, no_shape = CODES[adapter]
    whole, lines = by_kind(payloads) if adapter in ("generic", "github") else (payloads, payloads.limit(0))
    whole = whole.withColumns({"d": F.try_parse_json("raw"), "strict": F.coalesce(is_strict_json(F.col("raw")), F.lit(False))})
    top = F.col("d")
    listed = elements(F.col("raw"), *_lists(adapter)).isNotNull()
    shape = F.when(~F.col("strict"), no_json)
    if adapter == "grok":
        shape = shape.when(~_is(top, "OBJECT"), "invalid_grok_backend_shape")
    # a list of its own is no shape of the vendor whose payload is one object
    shape = shape.when(~listed | (F.lit(adapter == "grok") & _is(top, "ARRAY")), no_shape)
    found = [_found(whole, shape)]
    rows = whole.where("strict").where(listed).select("source_path", _is(top, "ARRAY").alias("flat"), F.posexplode(elements(F.col("raw"), *_lists(adapter))).alias("source_index", "row")).withColumn("d", F.try_parse_json("row"))
    found.append(_found(rows, _row_code(adapter), "source_index"))
    if adapter in ("claude", "gemini"):
        held = rows.where("not flat") if adapter == "gemini" else rows  # flat rows have their own rule
        told = reduce(lambda a, b: a | b, [_is(F.try_variant_get("d", f"$.{n}", "variant"), "ARRAY") for n in VENDORS[adapter].lists])
        found.append(_found(held.groupBy("source_path").agg(F.max(told.cast("int")).alias("told")), F.when(F.col("told") == 0, no_shape)))
    if adapter == "claude":
        nothing = whole.where("strict").where(listed).where(F.size(elements(F.col("raw"))) == 0)
        found.append(_found(nothing, F.lit(no_shape)))
    if adapter == "generic":
        said = rows.select("source_path", "source_index", F.posexplode(F.try_variant_get("d", "$.messages", "array<variant>")).alias("message_index", "m"))
        found.append(_found(said, F.when(~_is(F.col("m"), "OBJECT"), "invalid_generic_message"), "source_index", "message_index"))
    each = numbered_lines(lines).withColumn("d", F.try_parse_json("raw"))
    code = F.when(~F.coalesce(is_strict_json(F.col("raw")), F.lit(False)), "invalid_jsonl")
    if adapter == "generic":
        code = code.when(~_is(F.col("d"), "OBJECT"), "invalid_generic_jsonl_row").when(value(F.col("d"), *VENDORS["generic"].flat_key).isNull(), "generic_missing_conversation_id")
    elif adapter == "github":
        code = code.when(~_is(F.col("d"), "OBJECT"), no_shape).when(_without_thread_id(), "github_missing_thread_id")
    found.append(_found(each, code, "line"))
    return reduce(DataFrame.unionByName, found)


def _without_thread_id() -> Column:
    return F.rlike("source_path", F.lit(THREAD_RESOURCE)) & value(F.col("d"), "id", "node_id", "number").isNull()


def _row_code(adapter: str) -> Column:
    """Code of a conversation, wrapper or record that can't be read, or null."""
    no_object = ~_is(F.col("d"), "OBJECT")
    if adapter == "generic":
        return F.when(no_object, "invalid_generic_conversation").when(~_is(F.try_variant_get("d", "$.messages", "variant"), "ARRAY"), "generic_missing_messages")
    if adapter == "grok":
        return F.when(no_object | ~_is(F.try_variant_get("d", "$.conversation", "variant"), "OBJECT"), "invalid_grok_conversation_wrapper")
    if adapter == "github":
        return F.when(no_object, CODES[adapter][2]).when(_without_thread_id(), "github_missing_thread_id")
    if adapter == "gemini":
        return F.when(F.col("flat") & ~no_object & value(F.col("d"), *VENDORS["gemini"].flat_key).isNull(), CODES[adapter][2])
    if adapter == "claude":
        return F.lit(None).cast("string")
    return F.when(no_object, CODES[adapter][2])
