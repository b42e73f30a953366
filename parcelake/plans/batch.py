"""The batch stages in order: (bronze -> silver) per topic, then gold, then BI."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from parcelake.layout import Layout
from parcelake.plans import gold, layers, serve
from parcelake.schemas import ENTITIES


def run_batch(spark: SparkSession, layout: Layout, serving, as_of: Column,
              run_ts: Column, since: str | None = None) -> dict[str, object]:
    """Run all stages; returns their audit counts. `as_of` is the business date of the run,
    `since` the first ingest date whose raw rows and events are new (default: all)."""
    audit: dict[str, object] = {}
    for entity in ENTITIES.values():
        audit[f"bronze {entity.name}"] = layers.bronze(spark, entity, layout, run_ts, since)
        audit[f"silver {entity.name}"] = layers.silver(spark, entity, layout, run_ts, since)
    gold.build_calendar(spark, layout)
    audit["gold dimensions"] = gold.build_dimensions(spark, layout, as_of)
    audit["gold fact_shipment"] = gold.build_fact(spark, layout, as_of, run_ts, since)
    serve.refresh_bi(spark, layout, serving, run_ts)
    return audit
