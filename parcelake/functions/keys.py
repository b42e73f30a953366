from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

SEPARATOR = "|"
NULL_MARK = "\\N"


def _field(value: Column | str) -> Column:
    # Escaping keeps the joined text unambiguous: no field can contain a bare separator,
    # and no text can look like the null mark.
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(escaped, F.lit(NULL_MARK))


def fingerprint(columns: Sequence[Column | str]) -> Column:
    """md5 over the columns. Nulls count, so moving a value between columns changes it."""
    return F.md5(F.concat_ws(SEPARATOR, *[_field(c) for c in columns]))


def surrogate_key(natural_key: Column | str, valid_from: Column | str,
                  version_hash: Column | str, replaced: Column | str) -> Column:
    """Key of one version.

    The key of the version it replaces (null for the first) is part of it, so changing a value
    and back on one day still gives three different keys.
    """
    return fingerprint([natural_key, valid_from, version_hash, replaced])
