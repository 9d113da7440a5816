"""Prompts, responses, records, rejects."""

import json

from pyspark.sql import functions as F

from filingweave import fixed_values as fv
from filingweave import schemas
from filingweave.functions import rows as R
from filingweave.functions.headers import header_fields
from filingweave.operators import mapping
from filingweave.operators.grouped import run_metrics

HEADER = ["성 명", "직위", "담당업무", "주요경력", "소유주식수(의결권 있는 주식)", "비고"]


def collected(spark, rows, header=HEADER):
    data = [
        ("c", "C", "1", "분기", "u", "r", 0, i, json.dumps(dict(enumerate(cells)), ensure_ascii=False),
         json.dumps([str(n) for n in range(len(cells))]), json.dumps(header, ensure_ascii=False) if header else None, "t")
        for i, cells in enumerate(rows)
    ]
    names = ("company_id string, company string, stock_code string, report_type string, url string, rcept_no string, "
             "source_xml_index int, row_index int, row_json string, columns_json string, header_json string, row_text string")
    df = spark.createDataFrame(data, names)
    return df.withColumn("fields_json", F.to_json(header_fields(R.parse_columns(F.col("header_json")))))


def test_rule_mapper(spark):
    rows = [
        HEADER,
        ["홍길동", "사외이사", "ㆍ감사ㆍ자문", "(현) 서울대학교 경영학과 부교수", "10", "x"],
        ["김철수", "대표이사", "한성대 AI응용학과 교수", "서울대학교 법학과 조교수", "", ""],
        ["박 이", "이사", "총괄", "경력", "", ""],
        ["", "이사", "총괄", "", "", ""],
    ]
    results = mapping.map_by_rules(collected(spark, rows))
    mapped = {r.name: r for r in mapping.mapped_rows(results, "rules").collect()}
    assert mapped.keys() == {"홍길동", "김철수", "박 이"}
    first = mapped["홍길동"]
    assert (first.duty, first.school, first.department, first.prof_title) == ("감사, 자문", "서울대학교", "경영학과", "부교수")
    assert (first.shares_voting, first.shares_nonvoting, first.gender, first.llm_attempts) == ("10", "", "", 1)
    assert (mapped["김철수"].school, mapped["김철수"].prof_title) == ("한성대", "교수")
    assert (mapped["박 이"].school, mapped["박 이"].department, mapped["박 이"].prof_title) == ("해당없음",) * 3
    rejected = {r.row_index: r.error for r in mapping.rejected_rows(results).collect()}
    assert rejected == {0: "header row", 4: "no name"}
    assert [f.name for f in mapping.mapped_rows(results, "rules").schema] == schemas.MAPPED.names


def test_rule_mapper_without_header(spark):
    results = mapping.map_by_rules(collected(spark, [["a", "b"]], header=["x", "y"]))
    assert [r.error for r in mapping.rejected_rows(results).collect()] == ["no header"]
    results = mapping.map_by_rules(collected(spark, [["a", "b"]], header=None))
    assert [r.error for r in mapping.rejected_rows(results).collect()] == ["no header"]


def test_responses(spark):
    values = [
        '{"성명": "a"}', '```json\n{"성명": "b", "k": 1}\n```', ' {"성명": 3, "담당업무": {"x": 1}} ', "[1]", "no", None,
        '{"성명": null}', "``` \n{}\n  ```",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    parsed = df.select("i", mapping.parse_response(F.col("v")).alias("m"))
    record = mapping.record_from_map(F.col("m"))
    got = parsed.orderBy("i").select("m", record["name"].alias("name"), record["duty"].alias("duty"), mapping.extra_values(F.col("m")).alias("x")).collect()
    assert [r.name for r in got] == ["a", "b", "3", "", "", "", "", ""]
    assert got[2].duty == '{"x":1}' and got[1].x == {"k": "1"}
    assert [r.m is None for r in got] == [False, False, False, True, True, True, False, False]


def service():
    """Stands in for a service: reads the row off the prompt's end."""

    def answer(prompt):
        row = json.loads(prompt.split("|", 1)[1])
        if row.get("0") == "timeout":
            raise TimeoutError("too slow")
        if row.get("0") == "garbled":
            return "sorry"
        fields = {"성명": row.get("0", ""), "담당업무": row.get("1", ""), "회사": "other"}
        return "```json\n" + json.dumps(fields, ensure_ascii=False) + "\n```"

    return answer


def test_service_mapper(spark):
    rows = [["kim", "부교수"], ["timeout", ""], ["garbled", ""], [" ", ""], ["", "x"]]
    results = mapping.map_by_service(
        collected(spark, rows), service(), partitions=3, template="{columns}|{row}", max_attempts=2, drop_blank_cells=True
    )
    mapped = mapping.mapped_rows(results, "m").collect()
    assert [(r.name, r.prof_title, r.company, r.llm_model, r.error) for r in mapped] == [("kim", "부교수", "C", "m", "")]
    rejected = {r.row_index: (r.error, r.attempts, r.final) for r in mapping.rejected_rows(results).collect()}
    assert rejected == {
        1: ("too slow", 2, False), 2: ("not a JSON object", 1, True), 3: ("no cells", 0, True), 4: ("no name", 1, True),
    }


def test_prompt_is_literal_but_for_its_two_fields(spark):
    df = spark.createDataFrame([('["0"]', '{"0":"{row}"}')], "c string, r string")
    got = df.select(mapping.render_prompt(F.col("c"), F.col("r"), "{x} {columns} - {row} {columns}")).head()[0]
    assert got == '{x} ["0"] - {"0":"{row}"} {columns}'
    assert all(label in mapping.PROMPT for label in fv.RECORD_LABELS.values())


def test_run_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 1), (None, 3.0, 3)], "name string, llm_latency_ms double, llm_attempts int")
    assert tuple(run_metrics(df).head()) == (2, 1, 2.0, 3)
