"""Rounding rules used by reports and window aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round3(x: Column) -> Column:
    """Three decimals, ties toward +infinity.

    Scaling first to six decimals removes the last-bit noise a float sum picks up from
    the order of its inputs, so the result does not depend on partitioning.
    """
    return F.floor(F.round(x * 1000, 6) + 0.5) / 1000


def round_numeric(x: Column, digits: int) -> Column:
    """Round a double the way an exact numeric type does: ties away from zero.

    The decimal step plays the part of the double -> numeric cast, which drops float noise.
    """
    return F.round(x.cast("decimal(38,9)"), digits).cast("double")
