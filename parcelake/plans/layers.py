"""Batch jobs from the message log to silver.

Each job is one Spark action. Its audit counts are observed while it writes; nothing is
scanned again to be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from parcelake.layout import Layout
from parcelake.operators.clean import newest_copies, to_silver
from parcelake.operators.parse import parse_payload, to_envelope
from parcelake.schemas import Entity, empty
from parcelake.sizing import shuffles_sized_for
from parcelake.sources import fs, raw
from parcelake.sources.tables import Table


# Kept with the newest copies, so that later ones can be ranked against them.
LOG_POSITION = ("kafka_partition", "kafka_offset")


def row_count() -> Column:
    return F.count(F.lit(1)).alias("rows")


def ingest_batch(spark: SparkSession, log, entity: Entity, layout: Layout,
                 run_ts: Column) -> dict:
    """Append the whole topic to the raw layer, whatever is there: for a one-time load or a replay of
    another log. Repeated, it appends again; the job that runs daily is `ingest_new`."""
    seen = Observation(f"ingest {entity.name}")
    envelopes = to_envelope(log.scan(spark, entity.name), run_ts).observe(seen, row_count())
    raw.append(envelopes, layout.raw(entity.kind, entity.name))
    return seen.get


def ingest_new(spark: SparkSession, log, entity: Entity, layout: Layout, run_ts: Column) -> dict:
    """Append what the topic holds beyond the last run to the raw layer, and stop.

    The offsets of the runs are in the checkpoint of the topic, and the sink's own log says which
    files count: a run that is repeated, or that follows one that failed, appends every message
    once. A raw layer is filled by this or by `ingest_batch`, not by both, since readers go by the
    sink's log where there is one.
    """
    query = raw.start_append(
        to_envelope(log.stream(spark, entity.name, "earliest"), run_ts),
        layout.raw(entity.kind, entity.name), layout.checkpoint(f"ingest_{entity.name}"),
        {"availableNow": True})
    query.awaitTermination()
    return {"rows": sum(progress["numInputRows"] for progress in query.recentProgress)}


def _replace_dates(rows: DataFrame, path: str) -> None:
    """Replace the ingest dates that occur in `rows`; the other dates of the table stay."""
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingested_at").parquet(path)
    )


def bronze(spark: SparkSession, entity: Entity, layout: Layout, run_ts: Column,
           since: str | None = None) -> dict:
    """Parse raw into bronze, all ingest dates or those from `since` on.

    Bronze has the ingest-date partitions of raw, and a run replaces the partitions it read; so
    a daily run costs a day, and repeating it changes nothing. Rows that do not parse stay in
    the table, marked as quarantined: raw is read and parsed once for both kinds.
    """
    seen = Observation(f"bronze {entity.name}")
    rows = (
        parse_payload(raw.read(spark, layout.raw(entity.kind, entity.name), since), entity.payload)
        .withColumn("bronze_processed_at", run_ts)
        .select(*entity.bronze.fieldNames())
        .observe(seen, row_count(), F.count_if("quarantined").alias("quarantined"))
    )
    _replace_dates(rows, layout.bronze(entity.kind, entity.name))
    return seen.get


def bronze_rows(spark: SparkSession, entity: Entity, layout: Layout) -> DataFrame:
    path = layout.bronze(entity.kind, entity.name)
    if not fs.exists(spark, path):
        return empty(spark, entity.bronze)
    return spark.read.schema(entity.bronze).parquet(path)


def accepted(rows: DataFrame) -> DataFrame:
    """Rows of bronze or silver that passed."""
    return rows.where("NOT quarantined").drop("quarantined", "json_payload")


def quarantined(rows: DataFrame) -> DataFrame:
    """The others. Parquet statistics skip row groups that hold none."""
    return rows.where("quarantined").drop("quarantined")


def silver(spark: SparkSession, entity: Entity, layout: Layout, run_ts: Column,
           since: str | None = None) -> dict:
    """Clean, deduplicate and type bronze; rows with unreadable times are quarantined.

    Events are only appended, never replaced, so their silver keeps the ingest-date partitions
    and `since` limits the run as it does for bronze. Of other entities the newest copy counts;
    the stored copies keep their log position, so with `since` only new rows are read and merged
    into them. Merging a day again, or days in another order, changes nothing.
    """
    seen = Observation(f"silver {entity.name}")
    path = layout.silver(entity.kind, entity.name)
    stored = None
    if not entity.append_only and since is not None and Table(spark, path).exists():
        stored = Table(spark, path).read()
    source = bronze_rows(spark, entity, layout)
    if since is not None and (entity.append_only or stored is not None):
        source = source.where(F.col("ingested_at") >= F.lit(since).cast("date"))
    rows = to_silver(accepted(source), entity)
    columns = [c for c in entity.silver.fieldNames() if c != "silver_processed_at"]
    if stored is not None:
        kept = [*columns, *LOG_POSITION]
        rows = newest_copies(stored.select(*kept).unionByName(rows.select(*kept)), entity)
    rows = (
        rows.withColumn("silver_processed_at", run_ts)
        .observe(seen, row_count(), F.count_if("quarantined").alias("quarantined"))
    )
    columns = entity.silver.fieldNames()
    if entity.append_only:
        _replace_dates(rows.select(*columns, "ingested_at"), path)
    else:
        with shuffles_sized_for(spark, source, *([] if stored is None else [stored])):
            Table(spark, path).overwrite(rows.select(*columns, *LOG_POSITION))
    return seen.get


def silver_rows(spark: SparkSession, entity: Entity, layout: Layout,
                since: str | None = None) -> DataFrame:
    """Accepted silver rows; of append-only entities optionally those ingested from `since` on."""
    path = layout.silver(entity.kind, entity.name)
    if not entity.append_only:
        return accepted(Table(spark, path).read()).drop(*LOG_POSITION)
    if not fs.exists(spark, path):
        return accepted(empty(spark, entity.silver))
    dated = T.StructType([*entity.silver.fields, T.StructField("ingested_at", T.DateType())])
    rows = spark.read.schema(dated).parquet(path)
    if since is not None:
        rows = rows.where(F.col("ingested_at") >= F.lit(since).cast("date"))
    return accepted(rows.drop("ingested_at"))
