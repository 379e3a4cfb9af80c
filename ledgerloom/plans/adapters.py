"""Vendor payloads as canonical conversations and messages.

Every vendor is a row of field names over one shape: conversations that hold a list of messages, flat rows that name
their conversation, or a map of nodes.  Values are read from VARIANT, so missing and null fields are one thing and the
JSON type decides what counts as a text or a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import CONVERSATION_FILE, file_number, reference_keys, sorted_unique
from ledgerloom.operators.messages import canonical_conversations, canonical_messages, grouped_conversations
from ledgerloom.operators.threads import resolved_parents, thread_messages
from ledgerloom.sources.json_rows import all_strings, exploded, is_list, json_lines, number_text


@dataclass(frozen=True)
class Vendor:
    """Where a vendor keeps things: names are tried in order, the first that is not null counts."""

    adapter_id: str
    vendor: str
    source_type: str
    discovery: str
    lists: tuple[str, ...] = ("messages",)
    conversation_at: str = ""
    message_at: str = ""
    conversation: dict[str, tuple[str, ...]] = field(default_factory=dict)
    message: dict[str, tuple[str, ...]] = field(default_factory=dict)
    flat_key: tuple[str, ...] = ("conversation_id", "thread_id", "chat_id")


_TIMES = {"create_time": ("create_time", "created_at"), "update_time": ("update_time", "updated_at")}
# The vendors' field names and file names.
VENDORS = {
    "grok": Vendor(
        "grok-export/1", "xai", "xai.grok.export", "(^|/)prod-grok-backend\\.json$", ("responses",), "conversation", "response",
        {"source_conversation_id": ("id",), "title": ("title",), "create_time": ("create_time",), "update_time": ("modify_time",)},
        {"source_message_id": ("_id",), "own_conversation_id": ("conversation_id",), "role": ("sender",), "text": ("message",), "create_time": ("create_time",),
         "source_parent_id": ("parent_response_id",), "source_children_ids": ("children",), "model": ("model",), "attachment_refs": ("file_attachments",), "partial": ("partial",)},
    ),
    "claude": Vendor(
        "claude-export/1", "anthropic", "anthropic.claude.export", "(?i)(^|/)conversations\\.json$", ("chat_messages",), "", "",
        {"source_conversation_id": ("uuid", "id", "conversation_id"), "title": ("name", "title"), "create_time": ("created_at", "create_time"), "update_time": ("updated_at", "update_time")},
        {"source_message_id": ("uuid", "id", "message_id"), "role": ("sender", "role", "author"), "text": ("text", "content", "message"),
         "create_time": ("created_at", "create_time"), "update_time": ("updated_at", "update_time"), "attachment_refs": ("attachments", "files")},
    ),
    "gemini": Vendor(
        "gemini-export/1", "google", "google.gemini.export", "(?i)(^|/)(gemini|myactivity|my activity|conversations)\\.json$", ("entries", "messages"), "", "",
        {"source_conversation_id": ("id", "conversation_id", "thread_id"), "title": ("title",), **_TIMES},
        {"source_message_id": ("id", "message_id", "entry_id"), "role": ("role", "author", "sender"), "text": ("text", "content", "message", "prompt", "response"),
         "create_time": ("create_time", "created_at", "timestamp", "time"), "update_time": ("update_time", "updated_at"),
         "source_parent_id": ("parent_id", "parent_message_id"), "model": ("model",), "attachment_refs": ("attachments", "files")},
    ),
    "generic": Vendor(
        "generic-export/1", "generic", "generic.json", "(?i)\\.jsonl?$", ("messages",), "", "",
        {"source_conversation_id": ("id", "conversation_id", "thread_id", "chat_id"), "title": ("title",), **_TIMES},
        {"source_message_id": ("id", "message_id"), "role": ("role", "author", "sender"), "text": ("text", "content", "message"), "name": ("name",),
         "create_time": ("create_time", "created_at", "timestamp"), "update_time": ("update_time", "updated_at"), "source_parent_id": ("parent_id", "parent_message_id"),
         "source_children_ids": ("children",), "model": ("model",), "status": ("status",), "attachment_refs": ("attachments", "files", "attachment_refs")},
    ),
}
REFERENCE_FIELDS = ("id", "uuid", "file_id", "asset_id", "name", "file_name")
NUMBER = "^(BIGINT|DOUBLE|FLOAT|DECIMAL|INT|SMALLINT|TINYINT)"
ISSUE_RESOURCE = "(?i)(?:^|/)(issues|pull_requests|issue_comments|review_comments|pull_request_reviews)(?:[_-][0-9]+)?\\.jsonl?$"
ISSUE_LISTS = ("items", "records", "issues", "pull_requests", "issue_comments", "review_comments", "pull_request_reviews")


def value(document: Column, *names: str) -> Column:
    """The first of the named fields that is not null, as VARIANT."""
    found = [F.try_variant_get(document, f"$.{n}", "variant") for n in names]
    return F.coalesce(*(F.when(~F.is_variant_null(v), v) for v in found))


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def as_text(v: Column) -> Column:
    """A string; the strings of a list and the ``text`` strings of its objects, joined by line ends; an object's ``text``."""
    string = lambda x: F.when(kind(x) == "STRING", x.cast("string"))
    inner = lambda x: string(F.try_variant_get(x, "$.text", "variant"))
    parts = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.coalesce(string(x), inner(x)))
    return F.coalesce(string(v), F.when(F.startswith(kind(v), F.lit("ARRAY")), F.array_join(F.array_compact(parts), "\n")), inner(v), F.lit(""))


def as_time(v: Column) -> Column:
    """A string as it is written, a number by its value; null for other types."""
    return F.when(kind(v) == "STRING", v.cast("string")).when(F.rlike(kind(v), F.lit(NUMBER)), number_text(v))


def is_true(v: Column) -> Column:
    """Whether a value counts as true: not null, false, zero, or empty."""
    empty = F.to_json(v).isin("{}", "[]", '""', "false", "null")
    return F.coalesce(F.when(F.rlike(kind(v), F.lit(NUMBER)), v.cast("double") != 0).otherwise(~empty), F.lit(False))


def as_strings(v: Column) -> Column:
    """A list's members as strings; an empty list for other types."""
    return F.coalesce(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: x.cast("string")), F.array().cast("array<string>"))


def as_references(v: Column) -> Column:
    """A list's strings, and of its objects the first non-empty string among the reference fields."""
    string = lambda x: F.when(kind(x) == "STRING", F.nullif(x.cast("string"), F.lit("")))
    one = lambda x: F.coalesce(string(x), *(string(F.try_variant_get(x, f"$.{n}", "variant")) for n in REFERENCE_FIELDS))
    return F.coalesce(sorted_unique(F.transform(F.try_variant_get(v, "$", "array<variant>"), one)), F.array().cast("array<string>"))


_READERS = {"partial": is_true, "text": as_text, "create_time": as_time, "update_time": as_time, "source_children_ids": as_strings, "attachment_refs": as_references, "role": lambda v: F.when(kind(v) == "STRING", v.cast("string"))}


def _fields(document: Column, names: dict[str, tuple[str, ...]]) -> list[Column]:
    return [_READERS.get(n, lambda v: v.cast("string"))(value(document, *aliases)).alias(n) for n, aliases in names.items()]


def _stamped(rows: DataFrame, vendor: Vendor) -> DataFrame:
    return rows.withColumns({"adapter_id": F.lit(vendor.adapter_id), "source_vendor": F.lit(vendor.vendor), "source_type": F.lit(vendor.source_type)})


def nested(payloads: DataFrame, vendor: Vendor) -> tuple[DataFrame, DataFrame]:
    """Conversations and messages of ``payloads`` (source_path, raw) whose conversations hold their messages."""
    lists = [F.try_variant_get("d", f"$.{n}", "variant") for n in vendor.lists]
    rows = exploded(payloads).withColumn("list", F.coalesce(*(F.when(is_list(v), v) for v in lists)))
    rows = rows.where("list is not null") if not vendor.conversation_at else rows
    head = F.try_variant_get("d", f"$.{vendor.conversation_at}", "variant") if vendor.conversation_at else F.col("d")
    conversations = rows.select("source_path", "source_index", *_fields(head, vendor.conversation))
    items = rows.select("source_path", value(head, *vendor.conversation["source_conversation_id"]).cast("string").alias("conversation_id"), F.posexplode(F.try_variant_get("list", "$", "array<variant>")).alias("source_index", "m"))
    items = items.where(F.startswith(kind(F.col("m")), F.lit("OBJECT")))
    body = F.try_variant_get("m", f"$.{vendor.message_at}", "variant") if vendor.message_at else F.col("m")
    messages = items.select("source_path", "source_index", "conversation_id", *_fields(body, vendor.message))
    if "own_conversation_id" in messages.columns:
        messages = messages.withColumn("conversation_id", F.coalesce(F.nullif("own_conversation_id", F.lit("")), "conversation_id"))
    if "partial" in messages.columns:
        messages = messages.withColumn("status", F.when(F.col("partial"), "partial"))
    return canonical_conversations(_stamped(conversations, vendor)), canonical_messages(_stamped(messages, vendor))


def flat(payloads: DataFrame, vendor: Vendor, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Conversations and messages of ``payloads`` whose rows name their conversation: a list, or JSON lines."""
    rows = json_lines(payloads).withColumn("d", F.try_parse_json("raw")) if lines else exploded(payloads)
    keyed = rows.withColumn("conversation_id", value(F.col("d"), *vendor.flat_key).cast("string")).where("conversation_id is not null")
    titled = keyed.select("source_path", "conversation_id", "source_index", value(F.col("d"), "title").cast("string").alias("title"))
    groups = grouped_conversations(titled, "conversation_id", "source_index", "title")
    paths = keyed.groupBy("conversation_id").agg(F.min("source_path").alias("source_path"))
    conversations = groups.join(paths, "conversation_id").select("source_path", "source_index", F.col("conversation_id").alias("source_conversation_id"), "title")
    messages = keyed.select("source_path", "source_index", "conversation_id", *_fields(F.col("d"), vendor.message))
    return canonical_conversations(_stamped(conversations, vendor)), canonical_messages(_stamped(messages, vendor))


#: What each adapter stamps on its records, as (adapter_id, vendor, source_type).
IDENTITIES = {name: (v.adapter_id, v.vendor, v.source_type) for name, v in VENDORS.items()} | {
    "openai": ("openai-export/1", "openai", "openai.chatgpt.export"),
    "openai-common": ("openai-export-common/1", "openai", "openai.export"),
    "github": ("github-export/1", "github", "github.migration.export"),
}


def mapped(payloads: DataFrame, name: str = "openai") -> tuple[DataFrame, DataFrame]:
    """Conversations and messages of ``payloads`` whose conversations hold a ``mapping`` of nodes, in the file's order."""
    rows = exploded(payloads)
    identity = F.coalesce(F.nullif(value(F.col("d"), "id").cast("string"), F.lit("")), value(F.col("d"), "conversation_id").cast("string"))
    vendor = Vendor(*IDENTITIES[name], CONVERSATION_FILE)
    conversations = rows.select("source_path", "source_index", identity.alias("source_conversation_id"), *_fields(F.col("d"), {"title": ("title",), "create_time": ("create_time",), "update_time": ("update_time",)}))
    nodes = rows.select("source_path", identity.alias("conversation_id"), F.explode(nodes_in_order(F.get_json_object("raw", "$.mapping"), F.try_variant_get("d", "$.mapping", "map<string,variant>"))).alias("e"))
    nodes = nodes.select("source_path", "conversation_id", F.col("e.at").alias("source_index"), F.col("e.value").alias("n")).withColumn("m", value(F.col("n"), "message"))
    nodes = nodes.where(F.startswith(kind(F.col("m")), F.lit("OBJECT")))
    text = as_text(F.coalesce(F.try_variant_get("m", "$.content.parts", "variant"), F.try_variant_get("m", "$.content", "variant")))
    messages = nodes.select(
        "source_path", "source_index", "conversation_id", value(F.col("m"), "id").cast("string").alias("source_message_id"),
        value(F.col("n"), "parent").cast("string").alias("source_parent_id"), as_strings(value(F.col("n"), "children")).alias("source_children_ids"),
        F.try_variant_get("m", "$.author.role", "string").alias("role"), F.try_variant_get("m", "$.author.name", "string").alias("name"), text.alias("text"),
        as_time(value(F.col("m"), "create_time")).alias("create_time"), as_time(value(F.col("m"), "update_time")).alias("update_time"),
        value(F.col("m"), "status").cast("string").alias("status"), message_references(F.to_json("m")).alias("attachment_refs"),
    )
    if name == "openai-common":
        conversations = globally_numbered(conversations)
    return canonical_conversations(_stamped(conversations, vendor)), canonical_messages(_stamped(messages, vendor))


def nodes_in_order(text: Column, nodes: Column) -> Column:
    """Array of (at, value) of a mapping: values from ``nodes``, places from the order of keys in ``text``.  A VARIANT holds its members
    sorted; both sides are sorted by key once more and paired."""
    by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    places = F.array_sort(F.transform(F.json_object_keys(text), lambda k, i: F.struct(k.alias("key"), i.alias("at"))))
    paired = F.arrays_zip(places.alias("p"), F.array_sort(F.map_entries(nodes), by_key).alias("n"))
    return F.transform(paired, lambda x: F.struct(x["p"]["at"].alias("at"), x["n"]["value"].alias("value")))


def message_references(raw: Column) -> Column:
    """File names and ids that any string of a message mentions, sorted."""
    keys = F.flatten(F.transform(all_strings(raw), reference_keys))
    return sorted_unique(F.transform(keys, lambda k: F.regexp_replace(k, "^(name|id):", "")))


def globally_numbered(conversations: DataFrame) -> DataFrame:
    """``source_index`` counted on over the files, in the order of their numbers; one small row a file is summed up."""
    files = conversations.groupBy("source_path").agg(F.count("*").alias("n"))
    before = Window.orderBy(file_number(F.col("source_path")), F.encode("source_path", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("source_path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return conversations.join(bases, "source_path").withColumn("source_index", F.col("source_index") + F.col("base")).drop("base")


def conversation_strings(payloads: DataFrame) -> DataFrame:
    """source_path, source_index, conversation_id, title and all strings of every conversation of ``payloads``."""
    rows = exploded(payloads)
    identity = F.coalesce(F.nullif(value(F.col("d"), "id").cast("string"), F.lit("")), value(F.col("d"), "conversation_id").cast("string"))
    return rows.select("source_path", "source_index", identity.alias("conversation_id"), value(F.col("d"), "title").cast("string").alias("title"), F.explode(all_strings(F.col("raw"))).alias("text"))


def by_kind(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads of one JSON value, and of JSON lines."""
    lines = F.rlike("source_path", F.lit("(?i)\\.jsonl$"))
    return payloads.where(~lines), payloads.where(lines)


def issues(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations and messages of an issue tracker's resource files: threads, and the comments that reach one."""
    vendor = Vendor(*IDENTITIES["github"], ISSUE_RESOURCE)
    whole, lines = by_kind(payloads)
    rows = exploded(whole, *ISSUE_LISTS).unionByName(json_lines(lines).withColumn("d", F.try_parse_json("raw"))).withColumn("resource", F.lower(F.regexp_extract("source_path", ISSUE_RESOURCE, 1)))
    d = F.col("d")
    text = lambda *n: F.when(kind(value(d, *n)) == "STRING", value(d, *n).cast("string"))
    login = F.coalesce(F.try_variant_get("d", "$.user.login", "string"), F.try_variant_get("d", "$.author.login", "string"), text("author"))
    common = rows.select(
        "source_path", "source_index", "resource", login.alias("login"), F.coalesce(text("body"), F.lit("")).alias("body"), as_time(value(d, "created_at")).alias("create_time"),
        as_time(value(d, "updated_at")).alias("update_time"), value(d, "id", "node_id", "number").cast("string").alias("thread_id"), value(d, "id", "node_id").cast("string").alias("comment_id"),
        value(d, "number").cast("string").alias("number"), value(d, "title").cast("string").alias("title"), value(d, "issue_id", "pull_request_id", "subject_id").cast("string").alias("parent_id"),
        value(d, "pull_request_id", "subject_id").cast("string").alias("reviewed"), value(d, "pull_request_review_id", "review_id").cast("string").alias("review_id"),
    )
    threads = common.where(F.col("resource").isin("issues", "pull_requests"))
    named = F.concat(F.lit("GitHub "), F.when(F.col("resource") == "issues", "issue ").otherwise("pull request "), F.coalesce("number", "thread_id"))
    conversations = threads.select("source_path", "source_index", F.col("thread_id").alias("source_conversation_id"), F.coalesce("title", named).alias("title"), "create_time", "update_time")
    reviews = common.where(F.col("resource") == "pull_request_reviews").select(F.col("comment_id").alias("review_id"), F.col("reviewed").alias("thread_id"), F.struct("source_path", "source_index").alias("ord"))
    said = common.where(F.col("resource").isin("issue_comments", "review_comments", "pull_request_reviews")).drop("thread_id")
    said = resolved_parents(said.withColumn("review_id", F.when(F.col("resource") == "review_comments", F.col("review_id"))), reviews)
    rows_out = thread_messages(threads, said.where("thread_id is not null"))
    messages = rows_out.withColumnsRenamed({"thread_id": "conversation_id", "message_id": "source_message_id"})
    return canonical_conversations(_stamped(globally_numbered(conversations), vendor)), canonical_messages(_stamped(messages, vendor))


def discovered(members: DataFrame, name: str) -> DataFrame:
    """Members that an adapter reads, by their paths."""
    patterns = {n: v.discovery for n, v in VENDORS.items()} | {"openai": CONVERSATION_FILE, "openai-common": CONVERSATION_FILE, "github": ISSUE_RESOURCE}
    if name not in patterns:
        raise ValueError("unknown_adapter")
    return members.where(F.rlike("path", F.lit(patterns[name])))


def parse(payloads: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Conversations and messages of ``payloads`` by the named adapter."""
    if name in ("openai", "openai-common"):
        return mapped(payloads, name)
    if name == "github":
        return issues(payloads)
    if name not in VENDORS:
        raise ValueError("unknown_adapter")
    whole, lines = by_kind(payloads)
    if name == "gemini":  # a list holds flat rows that name their conversation
        is_list = F.coalesce(F.rlike("raw", F.lit("^\\s*\\[")), F.lit(False))
        both, rows = nested(whole.where(~is_list), VENDORS[name]), flat(whole.where(is_list), VENDORS[name])
        return both[0].unionByName(rows[0]), both[1].unionByName(rows[1])
    both = nested(whole, VENDORS[name])
    if name != "generic":
        return both
    rows = flat(lines, VENDORS[name], lines=True)
    return both[0].unionByName(rows[0]), both[1].unionByName(rows[1])
