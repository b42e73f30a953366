"""Token ids of documents as Parquet files made for selective reads.

Layout: one row per document with `shard` (the file's place in the order), `doc_id`, `before` (ids
of this shard before the document), `n_tokens` and the list `tokens`. The list is dictionary
encoded, the numbers are delta encoded; row groups and pages are small enough that the page
indexes, which Spark writes for every column, let a reader skip to some documents or read the
numbers without the ids.

Results in special cases: a null text is empty and has only the end id; a null doc_id comes first;
documents of one doc_id follow each other in the order of the hash of their text; repeated rows
are written as often as they come; of an empty table there is a file without rows.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelake.llm import tables, tokens

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 64 << 10
SLICE_BYTES = 2 << 20       # text encoded at a time: its pieces take some twenty times as much
CACHE_PIECES = 600_000      # nothing else needs the worker's memory here
SCHEMA = "shard int, doc_id long, before long, n_tokens long, tokens array<int>"
_NUMBERS = ("shard", "doc_id", "before", "n_tokens")


def encoded(docs: DataFrame, vocabulary: str, kind: str, end_id: int,
            cache_pieces: int | None = None) -> DataFrame:
    """Ids of doc_id, text in the order of the rows; `shard` is the task, `before` counts in it."""
    target = tables.arrow_schema(SCHEMA)
    end = end_id.to_bytes(4, sys.byteorder)

    def run(batches):
        encode = tokens.encoder(vocabulary, kind, cache_pieces).encode
        shard, before = TaskContext.get().partitionId(), 0
        for part in tables.slices(batches, SLICE_BYTES):
            ids = [i + end for i in encode(tables.raw(part.column("text")))]
            counts = np.array([len(i) // 4 for i in ids], np.int64)
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)), pa.int32()),
                pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield tables.as_batch({
                "shard": np.full(len(ids), shard, np.int32), "doc_id": part.column("doc_id"),
                "before": before + ends - counts, "n_tokens": counts,
                "tokens": lists.cast(target.field("tokens").type)}, target)
            before += int(ends[-1])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return tables.map_arrow(chosen, run, SCHEMA)


def write(encoded_docs: DataFrame, path: str) -> None:
    """Write encoded documents to `path` in the layout above, each task its own file."""
    writer = (encoded_docs.write.option("compression", "snappy")
              .option("parquet.writer.version", "PARQUET_2_0")
              .option("parquet.block.size", ROW_GROUP_BYTES)
              .option("parquet.page.size", PAGE_BYTES)
              .option("parquet.enable.dictionary", "true"))
    for name in _NUMBERS:
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.parquet(path)


def write_ordered(docs: DataFrame, path: str, vocabulary: str, kind: str, end_id: int) -> None:
    """Encode all documents and write them in ascending doc_id order."""
    chosen = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    ordered = chosen.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    write(encoded(ordered, vocabulary, kind, end_id, CACHE_PIECES), path)


def read(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The written rows; only the named columns are read."""
    found = spark.read.schema(SCHEMA).parquet(path)
    return found.select(*columns) if columns else found


def shard_starts(stored: DataFrame) -> dict[int, int]:
    """Ids of all shards before each shard: a prefix sum over one total per file."""
    totals = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()
    starts, at = {}, 0
    for shard, n in sorted((r["shard"], r["n"]) for r in totals):
        starts[shard] = at
        at += n
    return starts


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    starts = shard_starts(read(spark, path, "shard", "n_tokens"))

    def step(batch):
        column = batch.column("tokens")
        ids, ends = column.flatten().to_numpy(), np.cumsum(np.diff(column.offsets.to_numpy()))
        begins = np.concatenate(([0], ends[:-1]))
        base = np.array([starts[s] for s in batch.column("shard").to_pylist()], np.int64)
        return {"doc_id": batch.column("doc_id"), "start": base + batch.column("before").to_numpy(),
                "n_tokens": (ends - begins).astype(np.int64),
                "ids_crc32": [zlib.crc32(ids[b:e].astype("<u4").data) for b, e in zip(begins, ends)]}

    stored = read(spark, path, "shard", "doc_id", "before", "tokens")
    return tables.mapped(stored, step,
                         "doc_id long, start long, n_tokens long, ids_crc32 long")
