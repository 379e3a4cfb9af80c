"""Which messages refer to a member that is not kept, and how it is then described."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import basename, path_reference_keys, reference_keys
from ledgerloom.operators.ordered import running_sum


def attachment_index(texts: DataFrame, text: str = "text", context: tuple[str, ...] = ("source_path", "source_index", "conversation_id", "title")) -> DataFrame:
    """ref_key with each distinct context that mentions it."""
    own = [F.col(c) for c in context if c in texts.columns]
    return texts.select(F.explode(reference_keys(F.col(text))).alias("ref_key"), *own).distinct()


def index_lists(index: DataFrame) -> DataFrame:
    """ref_key, its number of contexts, and the first of them by path and index."""
    first = F.min(F.struct("source_path", "source_index"))
    return index.groupBy("ref_key").agg(F.count("*").alias("n_contexts"), first.alias("f")).select("ref_key", "n_contexts", F.col("f.source_path").alias("first_path"), F.col("f.source_index").alias("first_index"))


def posting_pages(index: DataFrame, page: int = 1_000, context: tuple[str, ...] = ("source_path", "source_index", "conversation_id", "source_message_id")) -> DataFrame:
    """ref_key, page, contexts: the rows of ``index`` (ref_key, ...) of each key in the order of ``context``, nulls as empty strings or 0, in
    lists of ``page`` rows.  Repeated rows stay.

    Rows are ranked over ranges of (key, context), so a key that very many rows mention is spread over tasks and no list is
    longer than a page."""
    kinds = dict(index.dtypes)
    order = [F.coalesce(c, F.lit("" if kinds[c] == "string" else 0)).alias(f"o{i}") for i, c in enumerate(context) if c in kinds]
    counted = index.groupBy("ref_key", *[c for c in context if c in kinds]).agg(F.count("*").alias("copies"))
    keyed = counted.withColumn("key", F.struct("ref_key", *order, F.struct(*[c for c in context if c in kinds])))
    placed = running_sum(keyed, "ref_key", "key", "copies", "through")
    each = placed.withColumn("nth", F.explode(F.sequence(F.col("through") - F.col("copies"), F.col("through") - 1)))
    entry = F.struct(F.col("nth"), *[F.col(c) for c in context if c in kinds])
    pages = each.groupBy("ref_key", F.floor(F.col("nth") / page).alias("page")).agg(F.sort_array(F.collect_list(entry)).alias("contexts"))
    return pages.withColumn("contexts", F.transform("contexts", lambda e: e.dropFields("nth")))


def described_by_any_key(members: DataFrame, index: DataFrame) -> DataFrame:
    """``members`` (path, kind) with the distinct contexts that any of their keys matches: their number, the first by
    source path and index, the keys that matched, and a label.  Members without a match stay.

    Contexts are counted once a key and members joined to what their keys have, so a key that many members and many contexts share
    costs their sum, not their product.  Members with several matching keys take the number of the most frequent one and, once for each
    such set of keys, the contexts of the others that lack it."""
    context = F.struct("source_path", "source_index", *[c for c in ("conversation_id", "title") if c in index.columns])
    mentions = index.select("ref_key", context.alias("context")).distinct()
    per_key = mentions.groupBy("ref_key").agg(F.count("*").alias("n"), F.min("context").alias("first"))
    keyed = members.withColumn("path_keys", path_reference_keys(F.col("path")))
    per_set = (
        keyed.select("path_keys").distinct().select("path_keys", F.explode("path_keys").alias("ref_key"))
        .join(per_key, "ref_key")
        .groupBy("path_keys")
        .agg(F.min("first").alias("first"), F.max(F.struct("n", "ref_key")).alias("most"), F.array_sort(F.collect_set("ref_key")).alias("reference_keys"))
    )
    several = per_set.where(F.size("reference_keys") > 1).select("reference_keys", F.col("most.ref_key").alias("most_key")).distinct()
    more = (
        several.select("reference_keys", "most_key", F.explode(F.array_remove("reference_keys", F.col("most_key"))).alias("ref_key"))
        .join(mentions, "ref_key")
        .select("reference_keys", "most_key", "context")
        .distinct()
        .join(mentions.select(F.col("ref_key").alias("most_key"), "context"), ["most_key", "context"], "left_anti")
        .groupBy("reference_keys")
        .agg(F.count("*").alias("more"))
    )
    counted = per_set.join(more, "reference_keys", "left").select("path_keys", "first", "reference_keys", (F.col("most.n") + F.coalesce("more", F.lit(0))).alias("reference_count"))
    out = keyed.join(counted, "path_keys", "left")
    return out.select(
        *members.columns,
        F.when(F.col("first").isNull(), "none").otherwise("exact").alias("reference_match"),
        F.coalesce("reference_count", F.lit(0)).alias("reference_count"),
        F.col("first.source_path").alias("source_file"),
        F.col("first.source_index").alias("source_index"),
        F.coalesce("reference_keys", F.array().cast("array<string>")).alias("reference_keys"),
        *(F.col(f"first.{c}").alias(name) for c, name in (("conversation_id", "conversation_id"), ("title", "conversation_title")) if c in index.columns),
        label(F.col("kind"), F.col("path"), F.col("first"), *(c for c in ("title", "conversation_id") if c in index.columns)).alias("label"),
    )


def described_by_one_key(members: DataFrame, index: DataFrame) -> DataFrame:
    """``members`` (path, ref_key) with the number of index rows of that key, repeats included, and the first of them."""
    first = F.min(F.struct("source_path", "source_index"))
    per_key = index.groupBy("ref_key").agg(F.count("*").alias("reference_count"), first.alias("first"))
    return members.join(per_key, "ref_key", "left").select(
        *members.columns,
        F.when(F.col("first").isNull(), "none").otherwise("exact").alias("reference_match"),
        F.coalesce("reference_count", F.lit(0)).alias("reference_count"),
        F.col("first.source_path").alias("source_file"),
        F.col("first.source_index").alias("source_index"),
    )


def label(kind: Column, path: Column, first: Column, *names: str) -> Column:
    """What a member is called: after the conversation's first name that is not empty, else after its index."""
    named = F.coalesce(*(F.nullif(first[n], F.lit("")) for n in names), first["source_index"].cast("string"))
    return F.when(first.isNull(), F.concat(kind, F.lit(" export asset: "), basename(path))).otherwise(F.concat(kind, F.lit(" referenced by conversation "), named, F.lit(": "), basename(path)))
