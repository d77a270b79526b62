"""Keeping an expensive expression from being evaluated once per reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pin(frame: DataFrame, *columns: str) -> DataFrame:
    """Make already computed columns opaque to filter push-down.

    The optimizer moves a filter below the projection it reads and copies the projected
    expression into it, so a parser referenced n times would run n times more per row.
    Passing the columns through a one-element generator stops that; it stays inside
    generated code and needs no cache.
    """
    keep = [c for c in frame.columns if c not in columns]
    return frame.select(*keep, F.inline(F.array(F.struct(*columns))))
