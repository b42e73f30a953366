"""Column expressions shared by the operators. All of them stay inside the JVM."""

from parcelake.functions.keys import fingerprint, surrogate_key
from parcelake.functions.lifecycle import band, by_code, stage_number
from parcelake.functions.numbers import percent, round_to
from parcelake.functions.times import elapsed, parse_utc

__all__ = [
    "band", "by_code", "elapsed", "fingerprint", "parse_utc", "percent", "round_to",
    "stage_number", "surrogate_key",
]
