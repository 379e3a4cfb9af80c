"""A folder into which message rows are dropped as JSON lines, read as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.messages import canonical_messages
from ledgerloom.plans.adapters import VENDORS, _fields, value

VENDOR = VENDORS["generic"]


def dropped_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical messages of the lines in ``folder``.  Lines that are no strict JSON object or name no conversation are
    left out; the file is the source path, and the order within it is by written time."""
    lines = spark.readStream.format("text").load(folder).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("raw"))
    rows = lines.withColumn("d", F.try_parse_json("raw")).withColumn("conversation_id", value(F.col("d"), *VENDOR.flat_key).cast("string")).where("conversation_id is not null")
    fields = rows.select("source_path", F.lit(0).cast("bigint").alias("source_index"), "conversation_id", *_fields(F.col("d"), VENDOR.message))
    return canonical_messages(fields.withColumns({"adapter_id": F.lit(VENDOR.adapter_id), "source_vendor": F.lit(VENDOR.vendor), "source_type": F.lit(VENDOR.source_type)}))


def collect_folder(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the last run to the Parquet table, then stop; a file is read exactly once."""
    return dropped_messages(spark, folder).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table)
