"""The company roster, whatever its headers look like."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingweave import fixed_values as fv
from filingweave.functions.text import trim_u


def canonical_headers(
    columns: Sequence[str], fragments: Mapping[str, Sequence[str]] = fv.ROSTER_HEADERS
) -> dict[str, str]:
    """Canonical name -> actual column. An exact name beats a name that only contains a fragment."""
    chosen: dict[str, str] = {}
    for target, parts in fragments.items():
        free = [c for c in columns if c not in chosen.values()]
        matching = [c for c in free if any(p in c.strip().lower() for p in parts)]
        exact = [c for c in matching if c.strip().lower() in parts[:2]]
        if matching:
            chosen[target] = (exact or matching)[0]
    missing = sorted(set(fragments) - set(chosen))
    if missing:
        raise ValueError(f"missing required columns: {missing}; found: {list(columns)}")
    return chosen


def as_text(df: DataFrame, column: str) -> Column:
    """A column as text; floating-point codes keep their digits instead of an exponent."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = c.cast("decimal(38,1)")
    return c.cast("string")


def canonical_roster(df: DataFrame) -> DataFrame:
    """Canonical columns first, as clean text (null -> ''); the others follow under their stripped names."""
    chosen = canonical_headers(df.columns)
    cleaned = {
        "corp_code": lambda c: trim_u(F.regexp_replace(trim_u(c), r"\.0$", "")),
        "corp_name": trim_u,
        "stock_code": trim_u,
    }
    core = [
        F.coalesce(cleaned[t](as_text(df, chosen[t])), F.lit("")).alias(t) for t in fv.ROSTER_HEADERS
    ]
    rest = [
        F.col(f"`{c}`").alias(c.strip())
        for c in df.columns
        if c not in chosen.values() and c.strip() not in fv.ROSTER_HEADERS
    ]
    return df.select(*core, *rest)


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header (every column text, nothing inferred) or parquet."""
    if path.rstrip("/").endswith(".parquet"):
        return canonical_roster(spark.read.parquet(path))
    return canonical_roster(spark.read.option("header", True).option("inferSchema", False).csv(path))
