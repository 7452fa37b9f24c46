"""Costly expressions that must run once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, however often it is used.

    The optimizer copies a projected expression into every filter and projection above it; it does not copy through a generator, and exploding an
    array of one keeps each row, nulls included."""
    return df.select("*", F.explode(F.array(expression)).alias(name))
