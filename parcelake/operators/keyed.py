"""One row per key: keep-latest, and a left lookup that survives hot and null keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelake.sizing import BROADCAST_BYTES, fits_broadcast

# A hot key's table row in the broadcast; with it the number of hot keys is bounded.
HOT_ROW_BYTES = 1024


def greatest_row(order_by: Sequence[str], columns: Sequence[str]) -> Column:
    """Aggregate: the whole row that is greatest by `order_by`, ties settled by all columns.

    It is a plain `max`, so Spark reduces every input split before the shuffle and a key
    that holds a large part of the table reaches its reducer as one row per split.
    """
    rest = [c for c in columns if c not in order_by]
    return F.max(F.struct(*order_by, *rest))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row of each key (nulls in `order_by` are oldest). Same columns as the input."""
    values = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(greatest_row(order_by, values).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*df.columns)


def hot_share(spark: SparkSession) -> float:
    """A key is hot if it has more rows than a shuffle partition's fair share. Fewer than 1/share
    keys can be, and their table rows have to fit a broadcast."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1.0 / max(1, min(partitions, BROADCAST_BYTES // HOT_ROW_BYTES))


def hot_hashes(df: DataFrame, *keys: str | Column, share: float | None = None) -> DataFrame:
    """(_n, _hash): hashes of the hot values of each key (numbered from 0) over the rows of `df`.

    All keys are counted in one pass over `df`. Two keys of one hash count together, which can
    only make a key hot that need not be.
    """
    share = hot_share(df.sparkSession) if share is None else share
    values = F.array(*[
        F.struct(F.lit(n).alias("_n"), F.when(_as_column(k).isNotNull(), F.xxhash64(k)).alias("_hash"))
        for n, k in enumerate(keys)])
    counts = (
        df.select(F.explode(values).alias("_v")).select("_v.*").where("_hash IS NOT NULL")
        .groupBy("_n", "_hash").agg(F.count("*").alias("_rows")))
    bounds = F.broadcast(counts.groupBy("_n").agg((F.sum("_rows") * F.lit(share)).alias("_bound")))
    return counts.join(bounds, "_n").where("_rows > _bound").select("_n", "_hash")


def _as_column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    *,
    spread_by: str,
    limit: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join `rows` with `table` on `key`, where `table` holds a key at most once.

    A table of checked size is broadcast. A larger one is joined by shuffle; then the hot
    keys are answered from a broadcast of their few table rows, and rows whose key is hot
    or null are dealt out over the shuffle by `spread_by` instead of meeting in one task.
    `hot` holds the hashes of the hot keys (column _hash of `hot_hashes`); callers that look up
    several keys count them in one pass over cheap rows. Default: counted on `rows`.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), key, "left")

    added = [c for c in table.columns if c != key]
    hot = (hot_hashes(rows, key) if hot is None else hot).select("_hash")
    hot_rows = (
        table.join(F.broadcast(hot), F.xxhash64(table[key]) == hot["_hash"], "left_semi")
        .select(key, F.struct(*added).alias("_hot"))
    )
    marked = rows.join(F.broadcast(hot_rows), key, "left")
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    keyed = (
        marked
        .withColumn("_key", F.when(~settled, F.col(key)))
        .withColumn("_deal", F.when(settled, F.xxhash64(spread_by)).otherwise(F.xxhash64(key)))
    )
    # A hash on both sides: a constant on one would leave the join's keys, and the shuffle with them.
    cold_rows = table.select(
        F.col(key).alias("_key"), F.xxhash64(key).alias("_deal"), F.struct(*added).alias("_cold"))
    joined = keyed.join(cold_rows, ["_key", "_deal"], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in added])
