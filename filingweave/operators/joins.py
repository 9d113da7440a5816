"""Joins whose hot keys are split while they run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", merge: bool = False) -> DataFrame:
    """Join on equal keys, key columns from the left; ``right`` is usually an aggregate by the same keys.

    Spark splits a hot partition only when the join reads both sides straight from a shuffle. An aggregate
    is already partitioned by its keys and would be joined as it lies, with no shuffle to split. Joining on
    one struct of the keys gives both sides a shuffle of their own: one more for the aggregated side, none
    for the left. Rows with a null key match nothing.

    ``merge``: neither side is ever sent to all tasks through the driver. For sides that Spark sizes too low: it takes
    what an explode makes for as many rows as went in, and stored columns for as large as their compressed files.
    """
    rest = [c for c in right.columns if c not in set(keys)]
    keyed = right.dropna(subset=list(keys)).select(F.struct(*keys).alias("_right"), *rest)
    if merge:
        keyed = keyed.hint("merge")
    joined = left.withColumn("_left", F.struct(*keys)).join(
        keyed, F.col("_left") == F.col("_right"), how
    )
    return joined.drop("_left", "_right")
