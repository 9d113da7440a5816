"""Company and stock codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingweave import fixed_values as fv


def zero_fill(digits: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept (plain lpad would cut it) and '' stays ''.

    Written without branches, so that code generation computes ``digits`` a single time.
    """
    length = F.length(digits)
    return F.lpad(digits, F.greatest(length, F.least(length, F.lit(1)) * width), F.lit("0"))


def normalize_code(c: Column, width: int) -> Column:
    """Strip, drop one trailing '.0', keep the digits, zero-fill; '' when no digit is left."""
    digits = F.regexp_replace(c.cast("string"), r"(?U)\.0(?=[\s\x1c-\x1f]*$)|\D", "")
    return F.coalesce(zero_fill(digits, width), F.lit(""))


def company_code(c: Column) -> Column:
    return normalize_code(c, fv.COMPANY_CODE_WIDTH)


def stock_code(c: Column) -> Column:
    return normalize_code(c, fv.STOCK_CODE_WIDTH)


def is_company_code(code: Column) -> Column:
    """Validity of an already normalised company code."""
    return F.length(code) == fv.COMPANY_CODE_WIDTH
