"""Columns of an input that an operator's own result columns replace."""

from __future__ import annotations

from pyspark.sql import DataFrame


def without(df: DataFrame, *added: str) -> DataFrame:
    """``df`` without columns that have the name of an added one, in any case."""
    taken = {name.lower() for name in added}
    return df.select(*[c for c in df.columns if c.lower() not in taken])
