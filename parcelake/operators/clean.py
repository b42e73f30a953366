"""Silver rules: key present, values valid, newest copy kept, lineage columns removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelake.operators.keyed import latest_per_key
from parcelake.operators.parse import cast_times
from parcelake.schemas import Entity, LINEAGE_COLUMNS


def valid_rows(entity: Entity) -> Column:
    """Key not null, positive columns > 0, coded columns inside their code list (null fails)."""
    rule = F.col(entity.key).isNotNull()
    for column in entity.positive:
        rule = rule & (F.col(column) > 0)
    for column, codes in entity.allowed:
        rule = rule & F.col(column).isin(*codes)
    return rule


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE_COLUMNS)


def to_silver(bronze: DataFrame, entity: Entity) -> DataFrame:
    """Typed, valid, deduplicated rows, plus `quarantined` rows whose times cannot be read.

    Times are checked before the newest copy is chosen, so an unreadable copy can never push
    out a good one. Quarantined copies all stay: they are told apart by log position. Both
    kinds leave in one pass over bronze with one shuffle (none for append-only entities).
    Lineage columns are still there; `drop_lineage` takes them off.
    """
    rows = bronze.where(valid_rows(entity))
    if entity.times:
        rows = cast_times(rows, entity.times, "quarantined")
    else:
        rows = rows.withColumn("quarantined", F.lit(False))
    return rows if entity.newest_by is None else newest_copies(rows, entity)


def newest_copies(rows: DataFrame, entity: Entity) -> DataFrame:
    """The newest copy of each key; quarantined copies all stay, told apart by log position.

    It is a maximum, so results of parts of the log can be put together and reduced again.
    """
    position = F.struct("kafka_partition", "kafka_offset")
    return latest_per_key(
        rows.withColumn("_bad_at", F.when(F.col("quarantined"), position)),
        [entity.key, "_bad_at"],
        [entity.newest_by, "kafka_offset"],
    ).drop("_bad_at")
