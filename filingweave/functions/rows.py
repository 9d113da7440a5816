"""Table rows as JSON, as readable text, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingweave.functions.text import trim_u


def clean_cells(cells: Column) -> Column:
    """Null cells become '', all cells are stripped."""
    return F.transform(cells, lambda c: trim_u(F.coalesce(c, F.lit(""))))


def column_names(cells: Column) -> Column:
    """Positional names '0' .. 'n-1'."""
    return F.transform(cells, lambda _, i: i.cast("string"))


def pad_cells(cells: Column, width: Column) -> Column:
    return F.concat(cells, F.array_repeat(F.lit(""), width - F.size(cells)))


def columns_json(cells: Column) -> Column:
    return F.to_json(column_names(cells))


def row_json(cells: Column) -> Column:
    return F.to_json(F.map_from_arrays(column_names(cells), cells))


def row_text(cells: Column) -> Column:
    """'0: a | 2: c', empty cells left out."""
    labelled = F.transform(
        cells, lambda c, i: F.when(c != "", F.concat(i.cast("string"), F.lit(": "), c))
    )
    return F.array_join(labelled, " | ")


def parse_columns(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def parse_row(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def drop_blank_entries(row: Column) -> Column:
    """A row map without private ('_...') keys and without null or blank values, values stripped."""
    kept = F.map_filter(
        row, lambda k, v: ~F.startswith(k, F.lit("_")) & (trim_u(F.coalesce(v, F.lit(""))) != "")
    )
    return F.transform_values(kept, lambda _, v: trim_u(v))
