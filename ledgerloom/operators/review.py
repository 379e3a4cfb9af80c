"""Decisions about artifacts, and checks of one set against another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import previous_value


def decision_coverage(artifacts: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """key, problem of every artifact without a decision, decision without an artifact, and key decided more than once."""
    a = artifacts.select(key).distinct().withColumn("_a", F.lit(True))
    d = decisions.groupBy(key).agg(F.count("*").alias("_n"))
    problem = F.when(F.col("_n").isNull(), "artifact_without_decision").when(F.col("_a").isNull(), "decision_without_artifact").when(F.col("_n") > 1, "decided_twice")
    return a.join(d, key, "full").select(key, problem.alias("problem")).where("problem is not null")


def decision_summary(decisions: DataFrame) -> DataFrame:
    """accepted, rejected and the summary of all decisions (accept or reject)."""
    n = decisions.agg(F.count_if(F.col("disposition") == "accept").alias("accepted"), F.count_if(F.col("disposition") == "reject").alias("rejected"))
    summary = F.when((F.col("accepted") > 0) & (F.col("rejected") > 0), "partially_accepted").when(F.col("accepted") > 0, "accepted").when(F.col("rejected") > 0, "rejected")
    return n.withColumn("summary", summary)


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, side of keys that only one of both has."""
    only_left = left.select(key).distinct().join(right.select(key), key, "left_anti").withColumn("side", F.lit("left"))
    only_right = right.select(key).distinct().join(left.select(key), key, "left_anti").withColumn("side", F.lit("right"))
    return only_left.unionByName(only_right)


def compared_trees(left: DataFrame, right: DataFrame) -> DataFrame:
    """path, status of every path of two trees (path, sha256, size_bytes): equal, changed, only_left or only_right."""
    l, r = (t.select("path", F.col("sha256").alias(f"{n}_sha"), F.col("size_bytes").alias(f"{n}_size")) for n, t in (("l", left), ("r", right)))
    status = (
        F.when(F.col("r_sha").isNull(), "only_left").when(F.col("l_sha").isNull(), "only_right")
        .when((F.col("l_sha") == F.col("r_sha")) & (F.col("l_size") == F.col("r_size")), "equal").otherwise("changed")
    )
    return l.join(r, "path", "full").select("path", status.alias("status"))


def out_of_order(rows: DataFrame, position: str, key: str, group: str) -> DataFrame:
    """Rows of each ``group`` whose ``key`` is not above that of the row before; a group may be larger than a task."""
    return previous_value(rows, group, position, key, "previous").where(F.col(key) <= F.col("previous"))


def split_by_decision(artifacts: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """``artifacts`` (key, path, ...) with their disposition and where they are staged: ``accepted/`` and the path, null where
    rejected.  Artifacts without a decision are left out; ``decision_coverage`` finds them."""
    decided = artifacts.join(decisions.select(key, "disposition"), key)
    return decided.withColumn("staged_path", F.when(F.col("disposition") == "accept", F.concat(F.lit("accepted/"), "path")))
