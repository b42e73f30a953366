"""Audit ingest: the event topics, from their start, into the raw layer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelake import domain
from parcelake.layout import Layout
from parcelake.operators.parse import to_envelope
from parcelake.schemas import ENTITIES
from parcelake.sources import raw
from parcelake.streaming.audit import observed


def start_ingest(spark: SparkSession, log, layout: Layout,
                 topics: Iterable[str] = domain.EVENT_TOPICS,
                 trigger: dict | None = None) -> list[StreamingQuery]:
    """One query per topic, all running at once."""
    return [
        raw.start_append(
            observed(to_envelope(log.stream(spark, topic, "earliest"), F.current_date()), f"ingest {topic}"),
            layout.raw(ENTITIES[topic].kind, topic),
            layout.checkpoint(f"ingest_{topic}"), trigger)
        for topic in topics
    ]


def await_any(spark: SparkSession) -> None:
    """Block until one query ends; its error, if any, is raised here."""
    spark.streams.awaitAnyTermination()
