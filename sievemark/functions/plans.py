"""Keeping costly columns from being computed twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, kept: Sequence[str], results: Mapping[str, Column]) -> DataFrame:
    """The kept columns and the results, the latter behind a one-row ``inline``.

    A filter on a projected column is otherwise moved below the projection by
    substituting the column's definition, which would compute it once for the
    filter and once more for the output.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in results.items()]))))
