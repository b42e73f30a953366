"""What the live path keeps between micro-batches.

The state of the shipments is Spark's own: a streaming aggregation in the state store. Beside it
lie the rows each batch changed (they go back into the aggregation, see `streaming.live`), the two
maintained views, which are small, and the history of the alerts. All are named by the batch id, and
a batch reads only what came before it, so a batch that is run again reads and writes the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parcelake.layout import Layout
from parcelake.operators.keyed import latest_per_key
from parcelake.operators.maintained import BACKLOG, OVERDUE, WAITING
from parcelake.schemas import ALERT, SHIPMENT_LIVE, empty, flat
from parcelake.sources import fs

# What a batch knows about a live row it wrote, besides the row.
WRITTEN = flat("batch_id bigint, arrived timestamp, event_id string, eta_alerted boolean")
CHANGED = T.StructType([*WRITTEN.fields, *SHIPMENT_LIVE.fields])

# Batches whose changed rows and views are kept. Only those of the last one are needed; the others
# give readers of the live table time to finish.
KEEP_BATCHES = 100


@dataclass(frozen=True)
class Batches:
    """Small tables written whole by each batch: `<path>/<batch id>/<name>`. A batch is complete when
    its clock is there, an empty directory named clock=<microseconds since 1970>."""

    spark: SparkSession
    path: str
    schemas: dict[str, T.StructType]

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in fs.child_names(self.spark, self.path) if n.isdigit())

    def clock(self, batch_id: int) -> int | None:
        marks = [n for n in fs.child_names(self.spark, f"{self.path}/{batch_id}") if n.startswith("clock=")]
        return int(marks[0].removeprefix("clock=")) if marks else None

    def last(self, before: int | None = None) -> int | None:
        """The newest complete batch, before batch `before` if it is given."""
        known = [n for n in self._numbers() if before is None or n < before]
        return next((n for n in reversed(known) if self.clock(n) is not None), None)

    def begin(self, batch_id: int) -> None:
        """Drop what an earlier attempt at the batch wrote."""
        fs.remove(self.spark, f"{self.path}/{batch_id}")

    def finish(self, batch_id: int, micros: int) -> None:
        fs.make_dir(self.spark, f"{self.path}/{batch_id}/clock={micros}")

    def read(self, name: str, batch_id: int | None) -> DataFrame:
        if batch_id is None:
            return empty(self.spark, self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{batch_id}/{name}")

    def write(self, name: str, batch_id: int, rows: DataFrame) -> None:
        rows.select(*self.schemas[name].fieldNames()).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/{batch_id}/{name}")

    def forget(self, batch_id: int) -> None:
        """Drop what batches before the kept ones wrote."""
        for old in self._numbers():
            if old <= batch_id - KEEP_BATCHES:
                fs.remove(self.spark, f"{self.path}/{old}")


def views(spark: SparkSession, layout: Layout) -> Batches:
    return Batches(spark, layout.live_views(), {"backlog": BACKLOG, "overdue": OVERDUE})


@dataclass(frozen=True)
class LiveTable:
    """One row per shipment: the state of the streaming aggregation and the rows of the last batches,
    which it has not taken in yet."""

    spark: SparkSession
    layout: Layout

    @property
    def changes_path(self) -> str:
        return self.layout.live()

    def write_changes(self, batch_id: int, rows: DataFrame) -> None:
        rows.select(*CHANGED.fieldNames()).write.mode("overwrite").parquet(f"{self.changes_path}/{batch_id}")

    def forget(self, batch_id: int) -> None:
        Batches(self.spark, self.changes_path, {}).forget(batch_id)

    def changes(self, before: int | None = None) -> DataFrame:
        numbers = [int(n) for n in fs.child_names(self.spark, self.changes_path) if n.isdigit()]
        paths = [f"{self.changes_path}/{n}" for n in numbers if (before is None or n < before)
                 and fs.is_complete(self.spark, f"{self.changes_path}/{n}")]
        return self.spark.read.schema(CHANGED).parquet(*paths) if paths else empty(self.spark, CHANGED)

    def stored(self) -> DataFrame:
        """The live rows in the state store, by Spark's reader of state (empty before the first batch)."""
        checkpoint = self.layout.checkpoint("live")
        if not fs.child_names(self.spark, f"{checkpoint}/commits"):
            return empty(self.spark, CHANGED)
        state = self.spark.read.format("statestore").load(checkpoint)
        # The state names its columns after the functions; they are in the order of
        # `live.shipment_state`, which ends with the row.
        kinds = [f.dataType for f in state.schema["value"].dataType.fields]
        named = T.StructType([T.StructField(f"c{n}", kind) for n, kind in enumerate(kinds)])
        row = F.col("value").cast(named).getField(f"c{len(kinds) - 1}")
        return state.select(row.alias("_row")).where("_row IS NOT NULL").select("_row.*")

    def read(self, columns: Sequence[str] = tuple(SHIPMENT_LIVE.fieldNames())) -> DataFrame:
        wanted = list(dict.fromkeys([*columns, "shipment_id", "batch_id"]))
        recent = self.changes().select(*wanted)         # listed before the state is looked at
        rows = recent.unionByName(self.stored().select(*wanted))
        return latest_per_key(rows, ["shipment_id"], ["batch_id"]).select(*columns)


def live_table(spark: SparkSession, layout: Layout) -> LiveTable:
    return LiveTable(spark, layout)


@dataclass(frozen=True)
class DueIndex:
    """Waiting shipments, partitioned by the hour they are due and the batch that wrote them."""

    spark: SparkSession
    path: str

    def _hours(self) -> list[str]:
        return [n for n in fs.child_names(self.spark, self.path) if n.startswith("due_hour=")]

    def before(self, batch_id: int) -> DataFrame:
        """The entries of earlier batches."""
        stored = T.StructType([*WAITING.fields, T.StructField("batch_id", T.LongType())])
        if not self._hours():
            return empty(self.spark, stored)
        return self.spark.read.schema(stored).parquet(self.path).where(F.col("batch_id") < batch_id)

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Add the entries of a batch; those of an earlier attempt are replaced."""
        for hour in self._hours():
            fs.remove(self.spark, f"{self.path}/{hour}/batch_id={batch_id}")
        (
            rows.withColumn("batch_id", F.lit(batch_id)).repartition("due_hour")
            .write.mode("append").partitionBy("due_hour", "batch_id").parquet(self.path)
        )

    def forget(self, hour: int) -> None:
        """Drop the hours before `hour`."""
        for name in self._hours():
            if int(name.removeprefix("due_hour=")) < hour:
                fs.remove(self.spark, f"{self.path}/{name}")


def due_index(spark: SparkSession, layout: Layout) -> DueIndex:
    return DueIndex(spark, layout.live_due())


@dataclass(frozen=True)
class AlertLog:
    """All alerts sent, by day and batch. Nothing reads it to decide what to send."""

    spark: SparkSession
    path: str

    def _days(self) -> list[str]:
        """The directories fired_on=yyyy-mm-dd of the history, oldest first."""
        return [n for n in fs.child_names(self.spark, f"{self.path}/history") if n.startswith("fired_on=")]

    def history(self, since: str | None = None) -> DataFrame:
        """All alerts, or those fired on `since` (yyyy-mm-dd) and later; only their days are listed."""
        days = [d for d in self._days() if since is None or d >= f"fired_on={since}"]
        if not days:
            return empty(self.spark, ALERT)
        return self.spark.read.schema(ALERT).option("basePath", f"{self.path}/history").parquet(
            *[f"{self.path}/history/{d}" for d in days]).select(*ALERT.fieldNames())

    def write(self, batch_id: int, alerts: DataFrame, day: str) -> None:
        """Log the alerts of a batch, fired on `day`; batches without alerts leave no files behind."""
        history = f"{self.path}/history"
        for earlier in self._days()[-2:]:               # of an earlier attempt, if any
            fs.remove(self.spark, f"{history}/{earlier}/batch_id={batch_id}")
        rows = alerts.select(*ALERT.fieldNames()).persist()
        try:
            if not rows.isEmpty():
                rows.coalesce(1).write.mode("overwrite").parquet(
                    f"{history}/fired_on={day}/batch_id={batch_id}")
        finally:
            rows.unpersist()
