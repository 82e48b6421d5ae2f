"""Comparing decisions with labelled expectations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(labelled: DataFrame, expected: Column, actual: Column, by: Sequence[str] = ()) -> DataFrame:
    """Documents per expected and actual outcome."""
    return (
        labelled.select(*by, expected.alias("expected"), actual.alias("actual"))
        .groupBy(*by, "expected", "actual")
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def passes(expected_flag: Column, actual_flag: Column, expected_categories: Column, categories: Column) -> Column:
    """Flags agree, and every expected category was raised (more may be)."""
    return (expected_flag == actual_flag) & (F.size(F.array_except(expected_categories, categories)) == 0)


def pass_counts(results: DataFrame, passed: Column) -> DataFrame:
    return results.agg(F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"))
