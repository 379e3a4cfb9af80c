"""Connected components of a link table, as repeated Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import dropped, written


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps: every node's larger neighbours, then its smaller ones, are hung on its
    smallest neighbour, until the links are stars.  Each step is a pre-aggregated minimum and an equi-join on the node,
    so a node with very many links is split by the adaptive join rather than gathered.  Null ends and self links are
    ignored; an empty table gives an empty result.
    """
    spark = links.sparkSession
    edges = (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges, path = written(edges, "links")

    def fingerprint(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = fingerprint(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges, new_path = written(small, "links")
        dropped(spark, path)
        path, now = new_path, fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
