"""The raw layer: immutable JSON lines of envelope rows, partitioned by ingest date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelake.schemas import ENVELOPE, empty
from parcelake.sources import fs


def append(envelopes: DataFrame, path: str) -> None:
    envelopes.write.mode("append").partitionBy("ingested_at").json(path)


def start_append(envelopes: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Streaming append. The sink's commit log makes a restart repeat or skip nothing.

    Readers of `path` go by that log, so nothing else may write there.
    """
    return (
        envelopes.writeStream.format("json").outputMode("append")
        .partitionBy("ingested_at")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Rows of all ingest dates, or of `since` and later (partitions before it are not listed
    for reading). The schema is given, so no inference pass; a path not yet written is empty."""
    if not fs.exists(spark, path):
        return empty(spark, ENVELOPE)
    rows = spark.read.schema(ENVELOPE).json(path)
    return rows if since is None else rows.where(F.col("ingested_at") >= F.lit(since).cast("date"))
