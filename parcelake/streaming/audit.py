"""Counts of each micro-batch: rows in, quarantined, written.

The plans of the streams observe their rows on the way (no second scan), and Spark reports the
counts with the progress of the batch. They are kept as one small file a batch, named by query and batch
id and written by the driver without a job. A batch that is repeated after a failure is reported again:
it replaces its file, or, on a later day, `batch_counts` takes the newer report. A driver that dies between
the commit of a batch and its report leaves that batch without a row.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from parcelake.layout import Layout
from parcelake.operators.keyed import latest_per_key
from parcelake.sources import fs

COUNTS = ("rows_in", "quarantined", "rows_written")
ROW = ("audit string, query_id string, batch_id long, reported_at timestamp, "
       + ", ".join(f"{name} long" for name in COUNTS))


def observed(df: DataFrame, audit: str, quarantined: Column | None = None) -> DataFrame:
    """`df` with its rows counted under the name `audit`; those where `quarantined` holds go no further."""
    bad = F.lit(False) if quarantined is None else F.coalesce(quarantined, F.lit(False))
    return df.observe(audit, F.count(F.lit(1)).alias("rows_in"), F.count_if(bad).alias("quarantined"))


class BatchAudit(StreamingQueryListener):
    """Keeps the counts that the batches of a session's streams report.

    Rows written are the rows in that are not quarantined, unless `written` knows the number for the
    batches of an audit.
    """

    def __init__(self, spark: SparkSession, layout: Layout) -> None:
        self.spark, self.layout = spark, layout
        self.written: dict[str, Callable[[int], int]] = {}

    def record(self, progress) -> None:
        """Keep the counts of one batch; the same batch may be recorded again."""
        for audit, counts in (progress.observedMetrics or {}).items():
            counts, batch = counts.asDict(), progress.batchId
            if set(counts) != {"rows_in", "quarantined"} or not counts["rows_in"]:
                continue                        # another observation, or a batch without rows
            rows = self.written.get(audit, lambda _: counts["rows_in"] - counts["quarantined"])(batch)
            line = {"audit": audit, "query_id": str(progress.id), "batch_id": batch,
                    "reported_at": progress.timestamp, **counts, "rows_written": rows}
            day = progress.timestamp[:10]
            fs.write_text(self.spark, f"{self.layout.audit()}/day={day}",
                          f"{audit.replace(' ', '-')}-{progress.id}-{batch}.json", json.dumps(line))

    def finish(self, query) -> None:
        """Record the batches of a query that has ended, whose reports may still be on their way."""
        for progress in query.recentProgress:
            self.record(progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def batch_counts(spark: SparkSession, layout: Layout, since: str | None = None) -> DataFrame:
    """One row per batch: the audit's name, query, batch and counts, reported on `since` or later."""
    if not fs.exists(spark, layout.audit()):
        return spark.createDataFrame([], ROW)
    rows = spark.read.schema(f"{ROW}, day date").json(layout.audit())
    if since is not None:
        rows = rows.where(F.col("day") >= F.lit(since).cast("date"))
    return latest_per_key(rows.drop("day"), ["audit", "query_id", "batch_id"], ["reported_at"])
