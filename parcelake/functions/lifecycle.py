from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from parcelake import domain


def stage_number(status: Column | str) -> Column:
    """1 for the first lifecycle stage .. 7 for the last; 0 if unknown; null if null."""
    status = F.col(status) if isinstance(status, str) else status
    return F.array_position(F.lit(list(domain.LIFECYCLE)), status).cast("int")


def by_code(code: Column | str, table: Mapping[str, object], default: object = None) -> Column:
    """Look a code up in a small fixed table; `default` for codes it does not hold."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), F.col(code) if isinstance(code, str) else code)
    return found if default is None else F.coalesce(found, F.lit(default))


def band(value: Column | str, panel: str) -> Column:
    """Colour of a panel value. A bound belongs to the band above it; null has no colour."""
    first, second, colours = domain.PANEL_BANDS[panel]
    value = F.col(value) if isinstance(value, str) else value
    colour = F.when(value < first, colours[0])
    if second is not None:
        colour = colour.when(value < second, colours[1])
    return colour.when(value.isNotNull(), colours[-1])
