"""Scratch tables in the cluster's shared folder, and Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SHARED = "spark.checkpoint.dir"
# Rows handed to one Python step at a time, and sent to a Python worker at once: few enough that
# long texts stay in bounds on both sides.
SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
BROADCAST_BYTES = 32 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session without one gets a folder of its own."""
    found = spark.conf.get(SHARED, None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED} to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set(SHARED, own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place, files = _files(spark, path)
    files.deleteOnExit(place)
    return path


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as readers other than Spark need it."""
    place, files = _files(spark, path)
    uri = files.makeQualified(place).toString()
    return uri if not uri.startswith("file:/") or uri.startswith("file:///") else "file://" + uri[5:]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A broadcast hint if the counted rows fit; beyond that Spark joins by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back_memory() -> None:
    """Return free buffers to the system: workers live on, and other stages need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """`mapInArrow` with batches of BATCH_BYTES (the session's limit is lowered to that), after which
    the worker gives its buffers back."""
    spark = df.sparkSession
    limit = spark.conf.get(_BATCH_CONF)
    if not limit.rstrip("b").isdigit() or int(limit.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, f"{BATCH_BYTES}b")

    def bounded(batches):
        try:
            yield from run(batches)
        finally:
            give_back_memory()

    return df.mapInArrow(bounded, schema)


def mapped(df: DataFrame, step: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Narrow Arrow map: `step` turns a slice into columns named as in `schema`."""
    target = arrow_schema(schema)

    def run(batches):
        for part in slices(batches):
            yield as_batch(step(part), target)

    return map_arrow(df, run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def as_batch(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type)
         for f in target for c in [columns[f.name]]], schema=target)


def kept(df: DataFrame, step: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """The rows of `df` for which `step` says true; columns stay as they are."""
    def run(batches):
        for part in slices(batches):
            yield part.filter(pa.array(step(part), pa.bool_()))

    return map_arrow(df, run, df.schema)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
