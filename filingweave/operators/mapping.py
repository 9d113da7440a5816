"""Raw table rows -> the canonical 16-field record.

The default mapper is a set of rules written as columns. A batch-inference service can take its place: render
a prompt for each row, run the hook on a bounded number of partitions, parse the responses.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingweave import fixed_values as fv
from filingweave import schemas
from filingweave.functions import rows as R
from filingweave.functions.headers import is_header, names_person
from filingweave.functions.text import bullets_to_commas, is_blank, trim_u
from filingweave.functions.titles import affiliation, fill_title_fields, find_title
from filingweave.operators.computed import computed

PROMPT = (
    "One row of an executive table follows.\n"
    "Column names: {columns}\n"
    "Row: {row}\n\n"
    "Return a JSON object with exactly these keys, \"\" where the row says nothing: "
    + ", ".join(fv.RECORD_LABELS.values())
    + ".\n"
    "Take 학교, 학과 and 교수 only from text that holds an academic title, 담당업무 before 주요경력; "
    f"without a title all three are {fv.NOT_APPLICABLE}. Separate duties by commas, without bullets."
)


def render_prompt(columns: Column, row: Column, template: str = PROMPT) -> Column:
    """The template with {columns} and {row} replaced; all else, braces included, is literal."""
    before, _, rest = template.partition("{columns}")
    between, _, after = rest.partition("{row}")
    return F.concat(F.lit(before), columns, F.lit(between), row, F.lit(after))


def strip_fence(response: Column) -> Column:
    """Drop the fence lines of a response that starts with a code fence."""
    text = trim_u(response)
    lines = F.filter(F.split(text, "\n"), lambda line: ~F.startswith(trim_u(line), F.lit("```")))
    return F.when(F.startswith(text, F.lit("```")), F.array_join(lines, "\n")).otherwise(text)


def parse_response(response: Column) -> Column:
    """map<string,string> of a JSON object response, values as text; null when it is not an object."""
    return F.from_json(strip_fence(response), "map<string,string>")


def record_from_map(values: Column) -> dict[str, Column]:
    """The record's columns from a map by label; '' when missing, also when there is no map."""
    return {
        name: F.coalesce(F.try_element_at(values, F.lit(label)), F.lit(""))
        for name, label in fv.RECORD_LABELS.items()
    }


def extra_values(values: Column) -> Column:
    """What a response holds beyond the record."""
    known = list(fv.RECORD_LABELS.values())
    return F.map_filter(values, lambda k, _: ~k.isin(known))


def with_title_rules(df: DataFrame, strict_title: bool = True) -> DataFrame:
    """Fill school, department and prof_title by the title found in duty, then career."""
    found = df.withColumn("_found", find_title([F.col("duty"), F.col("career")], strict_title=strict_title))
    filled = fill_title_fields(
        F.col("school"), F.col("department"), F.col("prof_title"), F.col("_found")
    )
    return found.withColumns(dict(zip(["school", "department", "prof_title"], filled))).drop("_found")


def with_rule_values(df: DataFrame, cells: str, fields: str) -> DataFrame:
    """Add the record's columns: cells by header field, duties cleaned, affiliation extracted."""

    def value(name: str) -> Column:
        at = F.array_position(fields, name).cast("int") - 1
        return F.coalesce(F.get(cells, at), F.lit(""))

    taken = ["school", "department", "prof_title"]
    read = computed(
        df, duty=bullets_to_commas(value("duty")),
        **{n: value(n) for n in fv.RECORD_FIELDS if n not in taken and n != "duty"},
    )
    source = F.when(find_title([F.col("duty")]).isNotNull(), F.col("duty")).otherwise(F.col("career"))
    return computed(read, _place=affiliation(source)).select(
        "*", *[F.col(f"_place.{f}").alias(n) for n, f in zip(taken, ["school", "department", "title"])]
    ).drop("_place")


def map_by_rules(collected: DataFrame, strict_title: bool = True) -> DataFrame:
    """Collected rows with the record's columns, ``attempts``, ``latency_ms``, ``error`` and ``retry`` (never).

    ``fields_json`` says which record field each cell is. Header rows, and rows of tables without a header, get an empty record and an error.
    """
    parsed = computed(
        collected,
        _cells=F.map_values(R.parse_row(F.col("row_json"))),
        _named=R.parse_columns(F.col("fields_json")),
    )
    why = F.when(is_header(F.col("_cells")), "header row").when(~names_person(F.col("_named")), "no header")
    judged = computed(parsed, error=why).withColumn(
        "_fields", F.when(F.col("error").isNull(), F.col("_named"))
    )
    valued = with_title_rules(with_rule_values(judged, "_cells", "_fields"), strict_title)
    return valued.withColumns({"attempts": F.lit(1), "latency_ms": F.lit(0.0), "retry": F.lit(False)}).drop(
        "_cells", "_named", "_fields"
    )


def call_service(
    prompts: DataFrame,
    ask: Callable[[str], str],
    partitions: int,
    keys: Sequence[str] = tuple(schemas.SOURCE_KEY),
    max_attempts: int = 3,
    pause_seconds: float = 0.0,
) -> DataFrame:
    """Add response, attempts, latency_ms and error to rows with a ``prompt``.

    ``partitions`` bounds how many calls run at once. Rows are spread by their key's hash, so one company's
    rows do not queue behind each other. A failing row is recorded, never dropped; a null prompt is not asked.
    """
    out = T.StructType(
        [
            *prompts.schema.fields,
            T.StructField("response", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("latency_ms", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def one(prompt: str) -> tuple[str | None, int, float, str | None]:
        start, error = time.monotonic(), None
        if prompt is None:
            return None, 0, 0.0, None
        for attempt in range(1, max_attempts + 1):
            try:
                return ask(prompt), attempt, (time.monotonic() - start) * 1000, None
            except Exception as e:
                error = str(e) or type(e).__name__
                time.sleep(pause_seconds * attempt * (attempt < max_attempts))
        return None, max_attempts, (time.monotonic() - start) * 1000, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            answers = [one(p) for p in pdf["prompt"]]
            names = ["response", "attempts", "latency_ms", "error"]
            yield pd.concat([pdf, pd.DataFrame(answers, columns=names, index=pdf.index)], axis=1)

    return prompts.repartition(partitions, *keys).mapInPandas(run, out)


def map_by_service(
    collected: DataFrame,
    ask: Callable[[str], str],
    partitions: int,
    template: str = PROMPT,
    strict_title: bool = True,
    drop_blank_cells: bool = False,
    max_attempts: int = 3,
    pause_seconds: float = 0.0,
) -> DataFrame:
    """Like map_by_rules, with the record taken from a service's JSON response.

    ``retry`` marks rows whose call failed: all other outcomes are final.
    """
    prompt = F.lit(True)
    row = F.col("row_json")
    if drop_blank_cells:
        values = R.drop_blank_entries(R.parse_row(row))
        prompt = F.size(values) > 0
        row = F.to_json(values)
    asked = call_service(
        collected.withColumn("prompt", F.when(prompt, render_prompt(F.col("columns_json"), row, template))),
        ask, partitions, max_attempts=max_attempts, pause_seconds=pause_seconds,
    )
    parsed = computed(asked, _values=parse_response(F.col("response")))
    refused = F.when(F.col("prompt").isNull(), "no cells").when(F.col("_values").isNull(), "not a JSON object")
    valued = parsed.withColumns(
        {
            **record_from_map(F.col("_values")),
            "retry": F.col("error").isNotNull(),
            "error": F.coalesce("error", refused),
        }
    )
    return with_title_rules(valued, strict_title).drop("_values", "prompt", "response")


def results_schema(collected: DataFrame) -> T.StructType:
    """What mapping adds to collected rows, for results that have not been written yet."""
    answer = [T.StructField("attempts", T.IntegerType()), T.StructField("latency_ms", T.DoubleType())]
    flags = [T.StructField("error", T.StringType()), T.StructField("retry", T.BooleanType())]
    return T.StructType([*collected.schema.fields, *schemas.RECORD.fields, *answer, *flags])


def last_answers(results: DataFrame) -> DataFrame:
    """Each row once: its final outcome, else one of the failed calls'."""
    order = Window.partitionBy(*schemas.SOURCE_KEY).orderBy("retry", F.desc("latency_ms"))
    return results.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def mapped_rows(results: DataFrame, model: str) -> DataFrame:
    """Results with a name, in the fixed layout of the mapped table."""
    return results.where(~is_blank(F.col("name"))).select(
        "company", "stock_code", "report_type", "url", *fv.RECORD_FIELDS,
        "company_id", "rcept_no", "source_xml_index", "row_index",
        F.lit(model).alias("llm_model"),
        F.col("latency_ms").alias("llm_latency_ms"),
        F.col("attempts").alias("llm_attempts"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


def rejected_rows(results: DataFrame) -> DataFrame:
    """The other results, with why: the error, or that the record has no name."""
    return results.where(is_blank(F.col("name"))).select(
        *schemas.SOURCE_KEY, "row_text", "attempts", "latency_ms",
        F.coalesce("error", F.lit("no name")).alias("error"),
        (~F.col("retry")).alias("final"),
    )
