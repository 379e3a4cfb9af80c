"""All values inside nested JSON, level by level, in the order of a recursive walk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.checkpoints import written

MAX_DEPTH = 1_000
_PATH = "array<struct<pos:int,key:string>>"


def leaves(documents: DataFrame, key: str, value: str) -> DataFrame:
    """``key``, place, kind and leaf (a VARIANT that is neither object nor list) for every leaf of the VARIANT column ``value``.

    ``place`` holds one (position, key) a level and sorts as a walk goes that takes an object's members by key and a list's in order.
    Each round opens the containers of one level by ``variant_explode``, so the rounds are as many as the deepest value has
    levels and every round's rows are dealt anew; a null value, and an empty container, have no leaves."""
    spark = documents.sparkSession
    level = documents.where(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.array().cast(_PATH).alias("place"), F.col(value).alias("v"))
    found = None
    for _ in range(MAX_DEPTH):
        level = written(level.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)), "walk-level")
        own = level.where(~F.col("kind").isin("OBJECT", "ARRAY"))
        found = own if found is None else found.unionByName(own)
        inner = level.where(F.col("kind").isin("OBJECT", "ARRAY"))
        if inner.isEmpty():
            return found.select(F.col("k").alias(key), "place", "kind", F.col("v").alias("leaf"))
        inner.createOrReplaceTempView("ledgerloom_walk")
        # members of an object are told apart by key alone, those of a list by position alone
        level = spark.sql(
            f"SELECT k, array_append(place, named_struct('pos', IF(kind = 'ARRAY', e.pos, 0), 'key', coalesce(e.key, ''))::{_PATH[6:-1]}) AS place, e.value AS v "
            "FROM ledgerloom_walk, LATERAL variant_explode(v) e"
        )
    raise ValueError("JSON nested too deep")


def strings(documents: DataFrame, key: str, value: str) -> DataFrame:
    """``key``, place, text of every string inside the VARIANT column ``value``; object keys are none."""
    return leaves(documents, key, value).where("kind = 'STRING'").select(key, "place", F.col("leaf").cast("string").alias("text"))
