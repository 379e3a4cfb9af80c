"""Threads and comments of an issue tracker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolved_parents(comments: DataFrame, reviews: DataFrame) -> DataFrame:
    """``comments`` (parent_id, review_id) with the thread they belong to: their own parent, else that of their review.

    ``reviews`` (review_id, thread_id, ord): of repeated reviews the last by ``ord`` counts."""
    last = reviews.where("review_id is not null and thread_id is not null").groupBy("review_id").agg(F.max_by("thread_id", "ord").alias("review_thread"))
    return comments.join(last, "review_id", "left").withColumn("thread_id", F.coalesce("parent_id", "review_thread")).drop("review_thread")


def thread_messages(threads: DataFrame, comments: DataFrame) -> DataFrame:
    """Thread bodies and their comments as messages (thread_id, message_id, role, name, text, create_time, source_index), with the
    source_path and update_time of their own rows where both tables have them.

    A comment joins every thread that has its id; empty texts and comments without a thread give no message."""
    more = [c for c in ("source_path", "update_time") if c in threads.columns and c in comments.columns]
    bodies = threads.where("body <> ''").select(
        "thread_id", F.concat(F.col("thread_id").cast("string"), F.lit(":body")).alias("message_id"), F.lit("author").alias("role"), F.col("login").alias("name"),
        F.col("body").alias("text"), "create_time", F.lit(0).cast("bigint").alias("source_index"), *more,
    )
    said = (
        comments.where("body <> ''")
        .select("thread_id", F.col("comment_id").cast("string").alias("message_id"), F.lit("commenter").alias("role"), F.col("login").alias("name"), F.col("body").alias("text"), "create_time", F.col("source_index").cast("bigint").alias("source_index"), *more)
        .join(threads.select("thread_id"), "thread_id")
    )
    return bodies.unionByName(said.select(bodies.columns))


def orphans(comments: DataFrame, threads: DataFrame) -> DataFrame:
    """Comments whose thread is not there, or that have none; the latter take no part in the join, where one task would get them all."""
    absent = comments.where("thread_id is not null").join(threads.select("thread_id"), "thread_id", "left_anti")
    return absent.unionByName(comments.where("thread_id is null"))
