from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed format of every time in the payloads. `X` reads the trailing "Z" as UTC whatever
# the session zone is; a quoted 'Z' would be read in the session zone.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssX"


def parse_utc(text: Column | str) -> Column:
    """ISO text to timestamp; null (not an error) when the text is no such time."""
    return F.try_to_timestamp(text, F.lit(ISO_SECONDS))


def elapsed(start: Column | str, end: Column | str, unit_seconds: float) -> Column:
    """Whole seconds from start to end in the given unit; null unless both are known."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(unit_seconds)
