"""Casts that turn bad input into NULL instead of failing (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_cast(col: Column | str, type_: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(type_)


def to_numeric(df: DataFrame, cols: list[str], type_: str = "double") -> DataFrame:
    """Coerce text columns to numbers; unparsable values become NULL."""
    return df.withColumns({c: F.trim(F.col(c)).try_cast(type_) for c in cols})
