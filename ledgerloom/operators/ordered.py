"""Values carried along an order, without one task for all rows or for all rows of a group.

Rows are dealt to ranges of (group, order) and written with the number of their range.  Each range works alone; what it
hands to the next is one small row per group, so a group of any size spans as many tasks as it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.checkpoints import checkpointed

RANGE = "__range"


def ranged(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with the number of their range of ``keys``; written, because the bounds of ranges are sampled anew at
    every evaluation."""
    return checkpointed(rows.repartitionByRange(*keys).withColumn(RANGE, F.spark_partition_id()))


def _before(summary: DataFrame, group: str, value: Column) -> DataFrame:
    """``summary`` (RANGE, group, ...) with ``value`` over the ranges before each, as __carried, keyed by __part, __group."""
    window = Window.partitionBy(group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(F.col(RANGE).alias("__part"), F.col(group).alias("__group"), value.over(window).alias("__carried"))


def _joined(rows: DataFrame, carried: DataFrame, group: str) -> DataFrame:
    same = (F.col(RANGE) == F.col("__part")) & F.col(group).eqNullSafe(F.col("__group"))
    return rows.join(carried, same, "left")


def running_sum(rows: DataFrame, group: str, order: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` up to and with each row of its ``group``, as ``name``; ``order`` is unique in a group."""
    dealt = ranged(rows, group, order)
    sums = dealt.groupBy(RANGE, group).agg(F.sum(value).alias("__sum"))
    local = F.sum(value).over(Window.partitionBy(RANGE, group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    both = _joined(dealt.withColumn("__local", local), _before(sums, group, F.sum("__sum")), group)
    return both.withColumn(name, F.col("__local") + F.coalesce("__carried", F.lit(0))).drop(RANGE, "__local", "__part", "__group", "__carried")


def previous_value(rows: DataFrame, group: str, order: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``value`` of the row before each in its ``group``, as ``name``, null for the first; ``order`` is unique in a group."""
    dealt = ranged(rows, group, order)
    lasts = dealt.groupBy(RANGE, group).agg(F.max_by(F.struct(value), order).alias("__last"))
    window = Window.partitionBy(RANGE, group).orderBy(order)
    local = dealt.withColumns({"__first": F.row_number().over(window) == 1, "__local": F.lag(value).over(window)})
    both = _joined(local, _before(lasts, group, F.last("__last")), group)
    return both.withColumn(name, F.when(F.col("__first"), F.col(f"__carried.{value}")).otherwise(F.col("__local"))).drop(
        RANGE, "__first", "__local", "__part", "__group", "__carried"
    )


def numbered(rows: DataFrame, key: str, column: str = "source_index") -> DataFrame:
    """``rows`` (unique ``key``) with their rank from 0 in the order of ``key``."""
    dealt = ranged(rows, key)
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy(RANGE).orderBy(key)) - 1)
    sizes = dealt.groupBy(RANGE).agg(F.count("*").alias("__n"))
    # one row a range
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(F.col(RANGE), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return ranked.join(base, RANGE).withColumn(column, (F.col("__base") + F.col("__rank")).cast("bigint")).drop(RANGE, "__rank", "__base")
