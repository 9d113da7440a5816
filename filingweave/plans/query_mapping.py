"""Queries on record mapping, responses and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.functions import rows as R
from filingweave.functions.headers import header_fields
from filingweave.operators import grouped, mapping
from filingweave.operators.computed import computed
from filingweave.operators.merge import named_only
from filingweave.plans.query_markup import CUSTOMER, customer_cells, few, join_text
from filingweave.plans.registry import query, table


EVENT = ["event_id", "event_type", "user_id"]


def event_response() -> Column:
    """A response for each event: fenced or not, with missing keys, numbers, extras, nulls or no JSON at all."""
    kind, user = F.col("event_type"), F.col("user_id")
    plain = join_text('{"성명": "', kind, '", "담당업무": ', user, ', "k": ', F.col("event_id"), "}")
    return (
        F.when(kind == "click", join_text("```json\n", plain, "\n  ```"))
        .when(kind == "view", join_text(" \n", '{"성명": null, "주요경력": "서울대학교 경영학과 부교수", "직위": "', kind, '"}'))
        .when(kind == "error", join_text("no answer ", user))
        .when(kind == "signup", join_text("[", plain, "]"))
        .otherwise(plain)
    )


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN event_type ELSE '' END AS name,
  CASE WHEN event_type IN ('click', 'purchase') THEN CAST(user_id AS VARCHAR) ELSE '' END AS duty,
  CASE WHEN event_type = 'view' THEN 'view' ELSE '' END AS position,
  CASE WHEN event_type = 'view' THEN '' ELSE '해당없음' END AS school,
  CASE WHEN event_type = 'view' THEN '부교수' ELSE '해당없음' END AS prof_title,
  CASE WHEN event_type IN ('click', 'purchase') THEN CAST(event_id AS VARCHAR) END AS k
FROM events WHERE event_type NOT IN ('error', 'signup')""")
def response_fields(spark: SparkSession, sf: str) -> DataFrame:
    parsed = computed(
        few(spark, sf, "events", *EVENT), v=mapping.parse_response(event_response())
    ).select("event_id", "v")
    records = parsed.where(F.col("v").isNotNull()).select(
        "event_id",
        *[c.alias(n) for n, c in mapping.record_from_map(F.col("v")).items()],
        F.try_element_at(mapping.extra_values(F.col("v")), F.lit("k")).alias("k"),
    )
    filled = mapping.with_title_rules(records)
    return filled.select("event_id", "name", "duty", "position", "school", "prof_title", "k")


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'mapped' ELSE 'rejected' END AS outcome,
  CASE WHEN event_type IN ('click', 'purchase') THEN '' WHEN event_type = 'view' THEN 'no name' ELSE 'not a JSON object' END AS error
FROM events""")
def rejects_split(spark: SparkSession, sf: str) -> DataFrame:
    parsed = computed(
        few(spark, sf, "events", *EVENT), v=mapping.parse_response(event_response())
    ).select("event_id", "v")
    events = parsed.select(
        *[c.alias(n) for n, c in mapping.record_from_map(F.col("v")).items()],
        F.when(F.col("v").isNull(), "not a JSON object").alias("error"),
        F.lit("c").alias("company_id"), F.col("event_id").cast("string").alias("rcept_no"),
        F.lit(0).alias("source_xml_index"), F.lit(0).alias("row_index"), F.lit("").alias("row_text"),
        F.lit("").alias("company"), F.lit("").alias("stock_code"), F.lit("").alias("report_type"), F.lit("").alias("url"),
        F.lit(1).alias("attempts"), F.lit(0.0).alias("latency_ms"), F.lit(False).alias("retry"),
    )
    number = F.col("rcept_no").cast("long").alias("event_id")
    good = mapping.mapped_rows(events, "rules").select(number, F.lit("mapped").alias("outcome"), "error")
    bad = mapping.rejected_rows(events).select(number, F.lit("rejected").alias("outcome"), "error")
    return good.unionByName(bad)


@query("""
SELECT c_custkey, 'Columns ["0","1","2"], row {"0":"' || c_name || '","1":"' || c_mktsegment || '","2":"' ||
  CASE WHEN c_nationkey < 9 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END || '"}; {answer} in JSON' AS prompt FROM customer""")
def prompt_render(spark: SparkSession, sf: str) -> DataFrame:
    cells = R.clean_cells(customer_cells())
    prompt = mapping.render_prompt(
        R.columns_json(cells), R.row_json(cells), "Columns {columns}, row {row}; {answer} in JSON"
    )
    return table(spark, sf, "customer").select("c_custkey", prompt.alias("prompt"))


@query("""
SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS position, c_mktsegment || ', 위원' AS duty,
  CASE WHEN c_nationkey < 12 THEN 'U' || c_custkey || '대학교' ELSE '해당없음' END AS school,
  CASE WHEN c_nationkey < 12 THEN '경영학과' ELSE '해당없음' END AS department,
  CASE WHEN c_nationkey < 12 THEN '조교수' ELSE '해당없음' END AS prof_title,
  CAST(c_custkey AS VARCHAR) AS shares_voting, '' AS shares_nonvoting, '2030.03' AS term_end
FROM customer""")
def rule_mapping(spark: SparkSession, sf: str) -> DataFrame:
    header = F.array(*[
        F.lit(h) for h in ["성 명", "직책", "담당 업무", "주요경력", "의결권있는주식(소유)", "임기 만료일", "비고"]
    ])
    career = F.when(
        F.col("c_nationkey") < 12, join_text("(현) U", F.col("c_custkey"), "대학교 경영학과 조교수")
    ).otherwise("前 연구원")
    body = F.array(
        F.col("c_name"), F.col("c_nationkey").cast("string"), join_text("·", F.col("c_mktsegment"), "ㆍ위원"),
        career, F.col("c_custkey").cast("string"), F.lit("2030.03"), F.lit("-"),
    )
    collected = few(spark, sf, "customer", *CUSTOMER).select(
        F.explode(F.array(header, body)).alias("cells"), header.alias("header")
    ).select(
        R.row_json(F.col("cells")).alias("row_json"), F.to_json(header_fields(F.col("header"))).alias("fields_json")
    )
    return named_only(mapping.map_by_rules(collected)).select(
        "name", "position", "duty", "school", "department", "prof_title", "shares_voting", "shares_nonvoting", "term_end"
    )


@query("""
SELECT event_type, count(*) AS rows, count(CASE WHEN user_id > 30 THEN 1 END) AS mapped,
  round(avg(value), 6) AS mean_latency_ms, CAST(max(user_id) AS INTEGER) AS max_attempts FROM events GROUP BY event_type""")
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    run = table(spark, sf, "events").select(
        "event_type", F.when(F.col("user_id") > 30, F.col("event_type")).alias("name"),
        F.col("value").alias("llm_latency_ms"), F.col("user_id").cast("int").alias("llm_attempts"),
    )
    return grouped.run_metrics(run, ["event_type"]).withColumn("mean_latency_ms", F.round("mean_latency_ms", 6))


def count_or_refuse(prompt: str) -> str:
    if prompt.startswith("de|"):
        raise ValueError("refused")
    return str(len(prompt))


@query("""
SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE CAST(length(text) + length(lang) + 1 AS VARCHAR) END AS response,
  CASE WHEN lang = 'de' THEN 2 ELSE 1 END AS attempts, CASE WHEN lang = 'de' THEN 'refused' END AS error
FROM documents""")
def parallel_map(spark: SparkSession, sf: str) -> DataFrame:
    prompts = table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit("|"), "text").alias("prompt"))
    answered = mapping.call_service(prompts, count_or_refuse, partitions=8, keys=["doc_id"], max_attempts=2)
    return answered.select("doc_id", "response", "attempts", "error")
