"""Type-2 dimensions: version columns, merge, change report and as-of lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelake import domain
from parcelake.functions import fingerprint, surrogate_key
from parcelake.operators.keyed import hot_hashes, lookup
from parcelake.sizing import fits_broadcast

VERSION_COLUMNS = ("row_hash", "effective_from", "effective_to", "is_current", "surrogate_key")


@dataclass(frozen=True)
class Dimension:
    name: str
    key: str
    tracked: tuple[str, ...]


FACILITY_ATTRIBUTES = ("city", "region", "state", "daily_capacity")

DIM_FULFILLMENT_CENTER = Dimension(
    "dim_fulfillment_center", "fulfillment_center_id",
    ("fulfillment_center_name", *FACILITY_ATTRIBUTES))
DIM_DELIVERY_STATION = Dimension(
    "dim_delivery_station", "delivery_station_id",
    ("delivery_station_name", *FACILITY_ATTRIBUTES))
DIM_VEHICLE = Dimension(
    "dim_vehicle", "vehicle_id",
    ("vehicle_type", "capacity", "home_facility_id", "home_facility_type", "status"))
DIM_CUSTOMER = Dimension("dim_customer", "customer_id", ("customer_tier",))


def first_versions(incoming: DataFrame, dim: Dimension, as_of: Column) -> DataFrame:
    """Every incoming row as an open version that starts on `as_of`."""
    return (
        incoming
        .withColumn("row_hash", fingerprint(dim.tracked))
        .withColumn("effective_from", as_of.cast("date"))
        .withColumn("effective_to", F.lit(domain.OPEN_END).cast("date"))
        .withColumn("is_current", F.lit(True))
        .withColumn("surrogate_key", surrogate_key(
            dim.key, "effective_from", "row_hash", F.lit(None)))
    )


def _side_by_side(existing: DataFrame, incoming: DataFrame, dim: Dimension, as_of: Column,
                  how: str) -> DataFrame:
    """Open versions and incoming versions of one key on one row, as structs `old` and `new`."""
    new = first_versions(incoming, dim, as_of).where(F.col(dim.key).isNotNull())
    old = existing.where("is_current")
    return (
        old.select(F.col(dim.key).alias("_key"), F.struct(*old.columns).alias("old"))
        .join(new.select(F.col(dim.key).alias("_key"), F.struct(*new.columns).alias("new")),
              "_key", how)
    )


def merge(existing: DataFrame, incoming: DataFrame, dim: Dimension, as_of: Column) -> DataFrame:
    """The dimension after `incoming` (one row per key) was seen on `as_of`.

    New keys are inserted, a changed key has its open version closed and a new one opened,
    unchanged keys and keys missing from `incoming` stay as they are. Closed history cannot
    change, so it is passed on without joining or shuffling it; only open versions meet the
    incoming rows, in one full outer join of two sides that are unique by key.
    Running it again with the same input and date gives the same table.
    """
    columns = existing.columns
    pairs = _side_by_side(existing, incoming, dim, as_of, "full")
    changed = F.col("old.row_hash") != F.col("new.row_hash")
    is_new = F.col("old").isNull()
    closing = as_of.cast("date")
    kept = F.struct(*[
        F.when(changed, F.lit(False)).otherwise(F.col("old.is_current")).alias(c)
        if c == "is_current"
        else F.when(changed, closing).otherwise(F.col("old.effective_to")).alias(c)
        if c == "effective_to"
        else F.col(f"old.{c}").alias(c)
        for c in columns
    ])
    next_key = surrogate_key(
        "_key", F.col("new.effective_from"), F.col("new.row_hash"), F.col("old.surrogate_key"))
    opened = F.struct(*[
        (next_key if c == "surrogate_key" else F.col(f"new.{c}")).alias(c) for c in columns])
    versions = (
        F.when(is_new, F.array(opened))
        .when(changed, F.array(kept, opened))
        .otherwise(F.array(kept))
    )
    touched = pairs.select(F.inline(versions))
    return existing.where("NOT is_current").unionByName(touched)


def changes(existing: DataFrame, incoming: DataFrame, dim: Dimension, as_of: Column) -> DataFrame:
    """Keys whose tracked attributes differ from the open version: key, old_hash, row_hash."""
    return (
        _side_by_side(existing, incoming, dim, as_of, "inner")
        .where(F.col("old.row_hash") != F.col("new.row_hash"))
        .select(F.col("_key").alias(dim.key), F.col("old.row_hash").alias("old_hash"),
                F.col("new.row_hash").alias("row_hash"))
    )


def current(table: DataFrame) -> DataFrame:
    return table.where("is_current")


# Days of a key that are sorted together when versions are carried forward.
SPAN_DAYS = 64


def as_of_version(rows: DataFrame, table: DataFrame, key: str, on_date: str,
                  columns: Sequence[str], spread_by: str,
                  asked: DataFrame | None = None) -> DataFrame:
    """Left lookup of the version that was valid on `on_date` (from inclusive, to exclusive).

    Versions that were opened and closed on one day were never valid and are left out. What
    remains of a key covers disjoint days, so it is at most one version per calendar day. A table
    of checked size is broadcast with its versions as a list per key; a larger one is resolved by
    `as_of_sorted`. Rows without key or date find nothing. `asked` is explained there.
    """
    valid = table.where("effective_from < effective_to").where(F.col(key).isNotNull())
    versions = valid.groupBy(key).agg(
        F.collect_list(F.struct("effective_from", "effective_to", *columns)).alias("_versions"))
    if not fits_broadcast(versions):
        return as_of_sorted(rows, table, key, on_date, columns, spread_by, asked)
    held = F.filter(
        "_versions",
        lambda v: (v["effective_from"] <= F.col(on_date)) & (F.col(on_date) < v["effective_to"]))
    return (
        lookup(rows, versions, key, spread_by=spread_by)
        .withColumn("_found", F.try_element_at(held, F.lit(1)))
        .select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])
    )


def as_of_sorted(rows: DataFrame, table: DataFrame, key: str, on_date: str,
                 columns: Sequence[str], spread_by: str,
                 asked: DataFrame | None = None) -> DataFrame:
    """`as_of_version` for tables of any size, as one pass over days in order.

    The asked (key, day) pairs, each once whatever the number of their rows, are put among the days
    on which versions start, and the last version is carried forward: within spans of SPAN_DAYS days,
    and from span to span by the last version of each span. So a group holds at most a span's days,
    or a key's spans, however many versions or rows the key has. Rows then look their pair up.

    `asked` holds the same keys and dates as `rows` (default: `rows`) and is read twice. Where lookups
    are chained it should be a table or a cheap plan, or each link would compute all before it again.
    """
    source = rows if asked is None else asked
    opened = (
        table.where("effective_from < effective_to").where(F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), F.col("effective_from").alias("_day"),
                F.struct("effective_to", *columns).alias("_version"), F.lit(False).alias("_asked")))
    date = F.col(on_date).cast("date")
    pairs = source.where(F.col(key).isNotNull() & date.isNotNull()).select(
        F.col(key).alias("_key"), date.alias("_day"),
        F.lit(None).cast(opened.schema["_version"].dataType).alias("_version"),
        F.lit(True).alias("_asked"))
    points = (
        opened.unionByName(pairs).groupBy("_key", "_day")
        .agg(F.any_value("_version", True).alias("_version"), F.bool_or("_asked").alias("_asked"))
        .withColumn("_span", F.floor(F.unix_date("_day") / F.lit(SPAN_DAYS))))
    up_to_here = Window.partitionBy("_key", "_span").orderBy("_day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    spans_before = Window.partitionBy("_key").orderBy("_span").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = F.when(F.col("_version").isNotNull(), F.col("_day"))
    carried = (
        points.groupBy("_key", "_span").agg(F.max_by("_version", starts).alias("_last"))
        .select("_key", "_span", F.last("_last", True).over(spans_before).alias("_before")))
    found = (
        points.withColumn("_inside", F.last("_version", True).over(up_to_here))
        .join(carried, ["_key", "_span"])
        .withColumn("_found", F.coalesce("_inside", "_before"))
        .where(F.col("_asked") & (F.col("_day") < F.col("_found.effective_to")))
        .select(F.struct("_key", "_day").alias("_at"), *[F.col(f"_found.{c}").alias(c) for c in columns]))
    pair = F.when(F.col(key).isNotNull() & date.isNotNull(),
                  F.struct(F.col(key).alias("_key"), date.alias("_day")))
    hot = hot_hashes(source.select(pair.alias("_at")), "_at")
    return lookup(rows.withColumn("_at", pair), found, "_at", spread_by=spread_by, hot=hot).select(
        *rows.columns, *columns)
