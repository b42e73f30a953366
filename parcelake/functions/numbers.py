from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to(value: Column, digits: int) -> Column:
    """Half-up rounding that ignores binary noise beyond ten decimals.

    Sums of doubles differ in their last bits with the order of addition, so two runs of
    one job could round a tie differently. Going through a decimal removes that.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent with one decimal; 0.0 when there is nothing to divide by."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return F.when(whole > 0, round_to(share, 1)).otherwise(F.lit(0.0))
