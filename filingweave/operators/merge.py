"""The two exported tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave import fixed_values as fv
from filingweave import schemas
from filingweave.functions.codes import company_code, is_company_code, stock_code
from filingweave.functions.text import is_blank
from filingweave.operators.grouped import distinct_on, first_non_null
from filingweave.operators.joins import split_join


def union_missing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Concatenate by column name; a column only one side has is null on the other."""
    return left.unionByName(right, allowMissingColumns=True)


def with_columns_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; absent ones are added as ''."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def named_only(df: DataFrame, column: str = "name") -> DataFrame:
    return df.where(~is_blank(F.col(column)))


def left_join_filled(
    left: DataFrame, info: DataFrame, keys: Sequence[str], defaults: Mapping[str, str]
) -> DataFrame:
    """Every left row once, with the info of its key; ``info`` holds each key once. Nulls get defaults."""
    joined = split_join(left, info.select(*keys, *defaults), keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def company_summary(roster: DataFrame, info: DataFrame, mark_bad_codes: bool = False) -> DataFrame:
    """Roster rows with report type and url; ``info`` has rows of (company_id, report_type, url, order key).

    ``mark_bad_codes`` reports invalid company codes under their own label instead of "no information".
    """
    order = [c for c in schemas.SOURCE_KEY if c in info.columns]
    per_company = first_non_null(info, ["company_id"], ["report_type", "url"], order)
    keyed = roster.withColumns(
        {
            "company_id": company_code(F.col("corp_code")),
            "company": F.coalesce("corp_name", F.lit("")),
            "stock_code": stock_code(F.col("stock_code")),
        }
    )
    filled = left_join_filled(
        keyed, per_company, ["company_id"], {"report_type": fv.NO_INFORMATION, "url": ""}
    )
    if mark_bad_codes:
        valid = is_company_code(F.col("company_id"))
        filled = filled.withColumn(
            "report_type", F.when(valid, F.col("report_type")).otherwise(fv.CODE_ERROR)
        )
    return filled.select(*fv.SUMMARY_LABELS)


def executive_sheet(mapped: DataFrame, dedupe: bool = True) -> DataFrame:
    """Named rows, one for each (company, name, position), in the fixed column order."""
    named = named_only(mapped)
    if dedupe:
        needed = [*fv.EXECUTIVE_LABELS, "position", *schemas.SOURCE_KEY]
        narrow = named.select(*[c for c in needed if c in named.columns])
        named = distinct_on(narrow, ["company", "name", "position"], schemas.SOURCE_KEY)
    return with_columns_present(named, list(fv.EXECUTIVE_LABELS))


def with_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(label) for c, label in labels.items()])
