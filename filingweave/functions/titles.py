"""Academic titles and affiliations inside free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingweave import fixed_values as fv
from filingweave.functions.text import first_contained, is_blank

# school, optional department, title: in that order, separated by blanks, copied as written
AFFILIATION = (
    r"(\S+?(?:대학교|대))(?=\s)(?:\s+(\S+?(?:학과|대학|학부|전공)))?"
    r"\s+(부교수|조교수|임용교수|전임강사|교수)"
)


def find_title(
    texts: Sequence[Column], titles: Sequence[str] = fv.PROFESSOR_TITLES, strict_title: bool = True
) -> Column:
    """The title found in the first text that has one, else null.

    With ``strict_title`` the longest matching title is reported ('부교수'); without it the first of the
    list, so that a title that contains another one is reported as the shorter.
    """
    words = sorted(titles, key=len, reverse=True) if strict_title else list(titles)
    return F.coalesce(*[first_contained(t, words) for t in texts])


def fill_title_fields(
    school: Column, department: Column, title: Column, found: Column, default: str = fv.NOT_APPLICABLE
) -> tuple[Column, Column, Column]:
    """Blank fields get the default when no title was found; with one, only a blank title is filled."""
    no_title = found.isNull()

    def fill(c: Column) -> Column:
        return F.when(no_title & is_blank(c), default).otherwise(F.coalesce(c, F.lit("")))

    filled = F.when(is_blank(title), F.coalesce(found, F.lit(default))).otherwise(title)
    return fill(school), fill(department), filled


def affiliation(text: Column) -> Column:
    """struct<school, department, title> taken verbatim from the text; '' where absent."""
    return F.struct(
        *[
            F.coalesce(F.regexp_extract(text, AFFILIATION, i), F.lit("")).alias(name)
            for i, name in enumerate(["school", "department", "title"], start=1)
        ]
    )
