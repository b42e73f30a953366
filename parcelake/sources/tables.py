"""Tables that are replaced as a whole (each overwrite is a new version directory) or by partition.

Parquet cannot overwrite what the same job reads, and a half-written table must never be
seen. So an overwrite writes `v=<n+1>` and readers take the highest version with a commit
marker. Where the Delta format is on the classpath, set spark.parcelake.table.format to
"delta" and its own transactional overwrite is used. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from parcelake.sources import fs


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    path: str
    keep: int = 2                # newest versions kept by `overwrite`

    @property
    def fmt(self) -> str:
        return self.spark.conf.get("spark.parcelake.table.format", "parquet")

    @property
    def _versioned(self) -> bool:
        return self.fmt != "delta"

    def versions(self) -> list[int]:
        return fs.numbered(self.spark, self.path, "v=")

    def exists(self) -> bool:
        """Explicit test; storage errors are raised, not taken for a missing table."""
        if self._versioned:
            return bool(self.versions())
        return fs.exists(self.spark, f"{self.path}/_delta_log")

    def read(self, version: int | None = None) -> DataFrame:
        if not self._versioned:
            reader = self.spark.read.format(self.fmt)
            if version is not None:
                reader = reader.option("versionAsOf", version)
            return reader.load(self.path)
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no committed version of table {self.path}")
        chosen = known[-1] if version is None else version
        return self.spark.read.format(self.fmt).load(f"{self.path}/v={chosen}")

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        writer = df.write.mode("overwrite").format(self.fmt).partitionBy(*partition_by)
        if not self._versioned:
            writer.option("overwriteSchema", "true").save(self.path)
            return
        # Also count versions without a marker, so a failed attempt is never mixed with ours.
        taken = [int(n[2:]) for n in fs.child_names(self.spark, self.path)
                 if n.startswith("v=") and n[2:].isdigit()]
        writer.save(f"{self.path}/v={max(taken, default=0) + 1}")
        for old in self.versions()[:-self.keep]:
            fs.remove(self.spark, f"{self.path}/v={old}")

    def replace(self, rows: DataFrame, by: str, parts: Sequence[int]) -> None:
        """Replace the partitions `parts` of a table partitioned by `by`; the others are not touched.

        `rows` may be read from these partitions, and hold rows of no others. It happens in place in
        the newest version: until it has ended, readers may see some partitions replaced and others
        not, and a run that failed has to be repeated.
        """
        if not parts:
            return
        writer = rows.write.mode("overwrite").format(self.fmt)
        if not self._versioned:
            listed = ", ".join(str(p) for p in parts)
            writer.option("replaceWhere", f"{by} IN ({listed})").save(self.path)
            return
        seen = Observation(f"partitions of {self.path}")
        path = f"{self.path}/v={self.versions()[-1]}"
        (
            rows.observe(seen, F.collect_set(by).alias("written"))
            .write.mode("overwrite").format(self.fmt).partitionBy(by)
            .option("partitionOverwriteMode", "dynamic").save(path)
        )
        # What was replaced by nothing is still there.
        for emptied in set(parts) - set(seen.get.get("written", [])):
            fs.remove(self.spark, f"{path}/{by}={emptied}")
