"""Raw envelope rows -> typed rows; what cannot be parsed is set aside, not lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from parcelake.functions import parse_utc

CORRUPT = "_corrupt_record"


def to_envelope(log: DataFrame, ingested_at) -> DataFrame:
    """Message-log rows (value, topic, partition, offset, timestamp) -> raw envelope."""
    return log.select(
        F.col("value").cast("string").alias("json_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        ingested_at.cast("date").alias("ingested_at"),
    )


def parse_payload(raw: DataFrame, payload: T.StructType, column: str = "json_payload") -> DataFrame:
    """Flatten the JSON text into the payload columns and add `quarantined`.

    Only NULL or empty text gives a null struct; other malformed text and values of a wrong
    type give a struct of nulls. Asking the parser for the corrupt record catches all of them.
    The text itself is kept for quarantined rows only.

    The struct goes through a one-element `explode`. Without it, Catalyst pushes every later
    filter on a payload column below the parse, and each such filter parses the text again.
    """
    schema = T.StructType([*payload.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in raw.columns if c != column]
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    return (
        raw.select(*others, column, F.explode(F.array(F.from_json(column, schema, options))).alias("_p"))
        .select(
            *[F.col(f"_p.{f.name}").alias(f.name) for f in payload.fields],
            *others,
            bad.alias("quarantined"),
            F.when(bad, F.col(column)).alias(column),
        )
    )


def cast_times(df: DataFrame, columns: Sequence[str], flag: str = "bad_time") -> DataFrame:
    """Turn ISO text columns into timestamps in place; `flag` marks rows with unreadable text."""
    unreadable = [F.col(c).isNotNull() & parse_utc(c).isNull() for c in columns]
    any_bad = unreadable[0]
    for one in unreadable[1:]:
        any_bad = any_bad | one
    return df.withColumn(flag, any_bad).withColumns({c: parse_utc(c) for c in columns})
