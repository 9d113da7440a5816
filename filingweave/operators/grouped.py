"""Grouped picks and counts. All of them combine on the map side, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingweave.operators.joins import split_join


def others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(keys)]


def first_non_null(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key and column, the first non-null value in the given order; rows with a null key are dropped."""
    position = F.struct(*order)
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*picks)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row, in the given order, of every key; null keys are equal to each other."""
    rest = others(df, keys)
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_pick"))
    return picked.select(*keys, "_pick.*").select(*df.columns)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with their counts, most frequent first; nulls left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first n rows of every key. ``order`` must decide all ties.

    Spark cuts each task's rows of a key to n before the shuffle, so a hot key hands on n rows a task.
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(whole)).where(F.col("_n") <= n).drop("_n")


def rows_of_first(df: DataFrame, keys: Sequence[str], index: str) -> DataFrame:
    """The rows of each key that hold its smallest index.

    The minimum is combined on the map side and joined back, and the join splits a hot key.
    """
    firsts = df.groupBy(*keys).agg(F.min(index).alias("_first"))
    return split_join(df, firsts, keys).where(F.col(index) == F.col("_first")).drop("_first")


def run_metrics(mapped: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, named rows, mean latency and most attempts of a mapping run."""
    return mapped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("name").alias("mapped"),
        F.avg("llm_latency_ms").alias("mean_latency_ms"),
        F.max("llm_attempts").alias("max_attempts"),
    )
