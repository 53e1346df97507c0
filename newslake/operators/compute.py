"""Working an expensive column out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters read as values.

    Spark moves a filter below the projection that makes its column, and then
    evaluates the column's expression there as well.  For tokens of a whole text
    that doubles the work.  A generator keeps the filter above it.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))


def explode_once(df: DataFrame, keep: list[str], values: Column | str, name: str, pos: str | None = None) -> DataFrame:
    """One row per element of an array that is expensive to make.

    Exploding adds a filter on the array's size, which would make it a second time.
    """
    values = F.col(values) if isinstance(values, str) else values
    made = compute_once(df, _values=values).select(*keep, "_values")
    if pos is None:
        return made.select(*keep, F.explode("_values").alias(name))
    return made.select(*keep, F.posexplode("_values").alias(pos, name))
