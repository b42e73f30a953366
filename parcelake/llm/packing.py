"""Packing of documents into sequences: concatenate and cut.

All documents' ids form one stream in the order of the stored shards. First pass: encode and write
the ids, each task counting its own; the sum of the totals of the tasks before gives every document
its place in the stream. Second pass: the stream is cut every `length` ids, and each piece of a
document in a sequence is one boundary record. Nothing is shuffled.

Only the last sequence can be short. It is padded to `length`, unless it has a power of two ids.

Results in special cases: a null or empty text has only the end id; null doc_ids and repeated rows
are packed as they come; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelake.llm import tables, token_files

LENGTH = 2048
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "padding long")


def padding(total: int, length: int = LENGTH) -> int:
    """Pad ids of the last sequence of a stream of `total` ids."""
    rest = total % length
    return 0 if rest & (rest - 1) == 0 else length - rest


def pack(docs: DataFrame, vocabulary: str, kind: str, end_id: int, length: int = LENGTH,
         with_ids: bool = False,
         cache_pieces: int | None = None) -> DataFrame:
    """Boundary records of all pieces, with ids_crc32 and, if wished, the ids of each piece."""
    spark = docs.sparkSession
    path = tables.scratch_path(spark, "packing")
    token_files.write(token_files.encoded(docs, vocabulary, kind, end_id, cache_pieces), path)
    numbers = token_files.read(spark, path, "shard", "n_tokens")
    starts = token_files.shard_starts(numbers)
    total = numbers.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    last, last_padding = total // length, padding(total, length)

    def step(batch):
        out = {name.split()[0]: [] for name in PIECES.split(", ")} | {"ids_crc32": [], "ids": []}
        column = batch.column("tokens")
        ids, offsets = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
        for i, (doc, shard, before) in enumerate(zip(*(
                batch.column(c).to_pylist() for c in ("doc_id", "shard", "before")))):
            own = ids[offsets[i]:offsets[i + 1]].astype("<u4")
            place, at = starts[shard] + before, 0
            while at < len(own):
                sequence, offset = divmod(place + at, length)
                piece = own[at:at + length - offset]
                out["doc_id"].append(doc)
                out["start"].append(at)
                out["length"].append(len(piece))
                out["doc_tokens"].append(len(own))
                out["sequence_id"].append(sequence)
                out["offset"].append(offset)
                out["padding"].append(last_padding if sequence == last else 0)
                out["ids_crc32"].append(zlib.crc32(piece.data))
                if with_ids:
                    out["ids"].append(piece)
                at += len(piece)
        if with_ids:
            ends = np.concatenate(([0], np.cumsum(out["length"]))).astype(np.int32)
            flat = np.concatenate([*out["ids"], np.zeros(0, "<u4")]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(
                pa.list_(pa.field("element", pa.int32())))
        return out

    schema = PIECES + ", ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return tables.mapped(token_files.read(spark, path, "shard", "doc_id", "before", "tokens"), step, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences from pieces with ids: at most `length` pieces each."""
    return (pieces.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"),
                 F.max("padding").alias("padding"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids"),
                    F.col("parts.doc_id").alias("doc_ids"), "padding"))
