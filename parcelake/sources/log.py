"""The message log: bounded and unbounded scans of topics.

On a cluster the log is Kafka. Where its connector is absent (tests, replays), the same rows
are read from files that hold the log columns: key, value, topic, partition, offset, timestamp.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from parcelake.schemas import flat
from parcelake.sources import replay

LOG_ROWS = flat(
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp")


@dataclass(frozen=True)
class KafkaLog:
    servers: str
    options: Mapping[str, str] = field(default_factory=dict)

    def _source(self, reader, topic: str):
        return (
            reader.format("kafka").option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", topic).options(**self.options)
        )

    def scan(self, spark: SparkSession, topic: str, since: str = "earliest",
             until: str = "latest") -> DataFrame:
        """Everything in the topic from `since` to `until`, once."""
        return (
            self._source(spark.read, topic)
            .option("startingOffsets", since).option("endingOffsets", until).load()
        )

    def stream(self, spark: SparkSession, topic: str, since: str = "earliest") -> DataFrame:
        """The topic as a stream: from its start ("earliest") or new rows only ("latest"). The
        checkpoint of the query keeps its offsets."""
        return self._source(spark.readStream, topic).option("startingOffsets", since).load()


@dataclass(frozen=True)
class ReplayLog:
    """Log rows in JSON files under `<path>/<topic>`. A new file is a new piece of the log."""

    path: str
    files_per_trigger: int | None = None

    def scan(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.schema(LOG_ROWS).json(f"{self.path}/{topic}")

    def stream(self, spark: SparkSession, topic: str, since: str = "earliest") -> DataFrame:
        """As above. From the start, Spark's file source keeps which files were read; for new rows
        only, `sources.replay` knows where the log ended when the query first started."""
        if since != "earliest":
            return replay.stream(spark, f"{self.path}/{topic}", since, self.files_per_trigger)
        reader = spark.readStream.schema(LOG_ROWS)
        if self.files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.files_per_trigger)
        return reader.json(f"{self.path}/{topic}")
