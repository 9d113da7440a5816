"""Filing listings: status routing, date window, report class, newest report by class priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingweave import fixed_values as fv
from filingweave.functions.text import contains_any
from filingweave.operators.grouped import others


def response_route(status: Column) -> Column:
    """'data', 'empty' or 'error'."""
    return (
        F.when(status == fv.STATUS_OK, "data")
        .when(status.isin(fv.STATUS_EMPTY), "empty")
        .otherwise("error")
    )


def report_class(
    title: Column, classes: Sequence[tuple[str, Sequence[str]]] = fv.REPORT_CLASSES
) -> Column:
    """The first class one of whose fragments occurs in the title, else null."""
    return F.coalesce(*[F.when(contains_any(title, words), label) for label, words in classes])


def report_code(label: Column, codes: dict[str, str] = fv.REPORT_CODES) -> Column:
    return F.coalesce(*[F.when(label == k, v) for k, v in codes.items()])


def viewer_url(base: str, number: Column) -> Column:
    return F.concat(F.lit(f"{base}?rcpNo="), F.coalesce(number, F.lit("")))


def in_window(day: Column, as_of: Column, years_back: int, fmt: str | None = "yyyyMMdd") -> Column:
    """``day`` inside [as_of - 365 * years_back days, as_of], both days included.

    ``fmt`` is the pattern of text days; None is for date and timestamp columns. The bounds are constants
    of the query, so the comparison reaches the scan.
    """
    first = F.date_sub(as_of, 365 * years_back)
    if fmt is None:
        return (day >= first) & (day < F.date_add(as_of, 1))
    return day.between(F.date_format(first, fmt), F.date_format(as_of, fmt))


def priority_rank(label: Column, priorities: Sequence[str]) -> Column:
    """n for the most wanted label down to 1; null for any other."""
    n = len(priorities)
    return F.coalesce(*[F.when(label == p, n - i) for i, p in enumerate(priorities)])


def latest_by_priority(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    priorities: Sequence[str],
    newest: Sequence[str],
    listing_order: Sequence[str] = (),
) -> DataFrame:
    """One row a key: the best label class first, then the newest inside it, then listing order.

    An aggregate rather than a window: every map task reduces a key to one row before the shuffle, so a
    key holding a third of the table costs no more than any other.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    newest_cols = [
        F.coalesce(F.col(c), F.lit("")) if isinstance(kinds[c], T.StringType) else F.col(c)
        for c in newest
    ]
    rank = priority_rank(F.col(label), priorities)
    ties = [-F.col(c) for c in listing_order]
    picked = (
        df.where(rank.isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*others(df, keys)), F.struct(rank, *newest_cols, *ties)).alias("_pick"))
    )
    return picked.select(*keys, "_pick.*")


def select_reports(items: DataFrame, key: str = "company_id", listing_order: Sequence[str] = ()) -> DataFrame:
    """Listing items -> the selected report of each company, with its type and code."""
    typed = items.withColumn("report_type", report_class(F.coalesce(F.col("report_nm"), F.lit(""))))
    chosen = latest_by_priority(
        typed, [key], "report_type", [c for c, _ in fv.REPORT_CLASSES], ["rcept_dt", "rcept_no"],
        listing_order,
    )
    return chosen.withColumn("reprt_code", report_code(F.col("report_type")))
