"""Columns that are computed exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps only read.

    Spark copies a plain column's expression into every filter it pushes down, and into later expressions
    with all their uses. What a generator gives is computed where it stands, so costly columns go through
    one, an array of a single struct.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
