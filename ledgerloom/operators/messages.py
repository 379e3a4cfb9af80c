"""Canonical conversations and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.constants import ADAPTER_PROTOCOL, CONVERSATION_PROTOCOL, MESSAGE_PROTOCOL
from ledgerloom.functions.text import normalized_role, sorted_unique
from ledgerloom.operators.ordered import numbered

STRING, LONG, LIST = "string", "bigint", "array<string>"
# Times stay as the source wrote them; ``*_text`` is how they sort.
CONVERSATION_FIELDS = {
    "protocol": STRING, "adapter_protocol": STRING, "adapter_id": STRING, "source_vendor": STRING, "source_type": STRING, "source_path": STRING,
    "source_index": LONG, "source_conversation_id": STRING, "title": STRING, "create_time": STRING, "update_time": STRING,
}
MESSAGE_FIELDS = {
    "protocol": STRING, "adapter_protocol": STRING, "adapter_id": STRING, "source_vendor": STRING, "source_type": STRING, "source_path": STRING,
    "source_index": LONG, "source_message_id": STRING, "source_parent_id": STRING, "source_children_ids": LIST, "conversation_id": STRING,
    "role": STRING, "name": STRING, "create_time": STRING, "update_time": STRING, "model": STRING, "status": STRING, "text": STRING, "attachment_refs": LIST,
}


def _projected(rows: DataFrame, fields: dict[str, str], fixed: dict[str, Column]) -> DataFrame:
    own = {c: F.col(c) for c in rows.columns} | fixed
    return rows.select(*(own.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields.items()))


def canonical_messages(rows: DataFrame) -> DataFrame:
    """``rows`` as messages: missing fields are null, roles normalised, references sorted and unique, texts never null."""
    own = rows.columns
    fixed = {"protocol": F.lit(MESSAGE_PROTOCOL), "adapter_protocol": F.lit(ADAPTER_PROTOCOL)}
    fixed["role"] = normalized_role(F.col("role"))
    fixed["text"] = F.coalesce("text", F.lit(""))
    none = F.array().cast(LIST)
    fixed["source_children_ids"] = F.coalesce("source_children_ids", none) if "source_children_ids" in own else none
    fixed["attachment_refs"] = F.coalesce(sorted_unique(F.col("attachment_refs")), none) if "attachment_refs" in own else none
    return _projected(rows, MESSAGE_FIELDS, fixed)


def canonical_conversations(rows: DataFrame) -> DataFrame:
    return _projected(rows, CONVERSATION_FIELDS, {"protocol": F.lit(CONVERSATION_PROTOCOL), "adapter_protocol": F.lit(ADAPTER_PROTOCOL)})


def linked_turns(turns: DataFrame, key: str = "conversation_id", order: str = "source_index", id_column: str = "source_message_id") -> DataFrame:
    """``turns`` with the id before each as its parent and the one after as its child."""
    window = Window.partitionBy(key).orderBy(order, id_column)
    after = F.lead(id_column).over(window)
    return turns.withColumns(
        {"source_parent_id": F.lag(id_column).over(window), "source_children_ids": F.when(after.isNull(), F.array().cast(LIST)).otherwise(F.array(after))}
    )


def message_order() -> list[Column]:
    """By conversation, written time, position and id; nothing missing sorts as the empty string."""
    empty = F.lit("")
    return [F.coalesce("conversation_id", empty), F.coalesce("create_time", empty), F.col("source_index"), F.coalesce("source_message_id", empty)]


def conversation_order() -> list[Column]:
    return [F.col("source_path"), F.col("source_index"), F.coalesce("source_conversation_id", F.lit(""))]


def grouped_conversations(rows: DataFrame, key: str, position: str, title: str | None = None) -> DataFrame:
    """One row per value of ``key``: its index in key order, its first row's title, its number of rows.

    Groups are aggregated before they are numbered, and numbered over range-partitioned keys: counts of the partitions
    give each its first index, so no single task sees all of them."""
    first = F.min_by(title, position) if title else F.lit(None).cast("string")
    groups = rows.groupBy(key).agg(first.alias("title"), F.count("*").alias("n_messages"))
    return numbered(groups, key).select(F.col(key), "source_index", "title", "n_messages")


def edges(messages: DataFrame) -> DataFrame:
    """conversation_id, parent_id, child_id of every parent link."""
    return messages.where("source_parent_id is not null").select("conversation_id", F.col("source_parent_id").alias("parent_id"), F.col("source_message_id").alias("child_id"))


def joined_parts(parts: Column) -> Column:
    """Text of a content list: its strings, joined by line ends."""
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n")
