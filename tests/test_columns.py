"""Codes, text, headers, titles, rows, roster headers."""

import re

import pytest
from pyspark.sql import functions as F

from filingweave.functions import codes, rows, text, titles
from filingweave.functions.headers import header_field, is_header
from filingweave.operators import reports
from filingweave.sources.roster import canonical_headers, canonical_roster


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def python_code(value, width):
    if value is None:
        return ""
    digits = re.sub(r"\D", "", re.sub(r"\.0$", "", value.strip()))
    return digits.zfill(width) if digits else ""


CODES = [
    "00126380", "126380", "1263801", "126380.0", "A126380", "123456789", None, "", "nan", "１2a", "\t126380  ",
    "5930", "36720.0", "1234567", " 36720.0　", "1.0.0", ".0", "0", "00000000", "12.0x", "7.0\x1f", "-5",
]


def test_codes_match_plain_python(spark):
    assert column(spark, CODES, codes.company_code) == [python_code(c, 8) for c in CODES]
    assert column(spark, CODES, codes.stock_code) == [python_code(c, 6) for c in CODES]
    assert column(spark, ["123456789", "126380", ""], lambda c: codes.is_company_code(codes.company_code(c))) == [
        False, True, False,
    ]


def test_codes_of_numbers(spark):
    df = spark.createDataFrame([(12345678.0,), (36720.0,), (None,)], "`corp_code` double").selectExpr(
        "corp_code", "'n' as corp_name", "'1' as stock_code"
    )
    assert [r.corp_code for r in canonical_roster(df).collect()] == ["12345678", "36720", ""]


def test_unicode_strip_and_squash(spark):
    values = ["  a b　\x1c", " ", None, "a​b", "\"x' \t\n y\""]
    assert column(spark, values, text.trim_u) == [None if v is None else v.strip() for v in values]
    assert column(spark, values, text.is_blank) == [(v or "").strip() == "" for v in values]
    want = [None if v is None else re.sub(r"\s+", "", v.replace('"', "").replace("'", "")) for v in values]
    assert column(spark, values, text.squash) == want


def test_token_count_is_presence(spark):
    assert column(spark, ["성명성명", "성명직위", "담당", ""], text.token_count) == [1, 2, 1, 0]


@pytest.mark.parametrize(
    "body, hint",
    [
        ("x 가. 임원의 현황 가. 등기임원", "가. 임원의 현황"),
        ("가. 등기임원", "가. 등기임원"),
        ("가. 임원 현황", "가. 임원 현황"),
        ("등기임원", "등기임원"),
        ("임원의 현황", "임원 현황"),
        ("임원", ""),
    ],
)
def test_document_hint(spark, body, hint):
    assert column(spark, [body], text.document_hint) == [hint]


def test_bullets_golden(spark):
    values = ["ㆍDX부문장 직무대행ㆍMX사업부장", "·기획실장·인사실장", "대표이사", "", "•"]
    assert column(spark, values, text.bullets_to_commas) == [
        "DX부문장 직무대행, MX사업부장", "기획실장, 인사실장", "대표이사", "", "",
    ]


def test_affiliation_golden(spark):
    values = [
        "한성대 AI응용학과 교수", "서울대학교 경영학과 부교수", "고려대학교 경제학과 조교수", "서울대학교 의과대학 교수",
        "서울대학교 교수", "대표이사",
    ]
    got = [tuple(r) for r in column(spark, values, titles.affiliation)]
    assert got == [
        ("한성대", "AI응용학과", "교수"), ("서울대학교", "경영학과", "부교수"), ("고려대학교", "경제학과", "조교수"),
        ("서울대학교", "의과대학", "교수"), ("서울대학교", "", "교수"), ("", "", ""),
    ]


def test_titles_strict_and_listed(spark):
    values = ["부교수", "조교수", "임용교수", "전임강사", "교수", "이사", ""]
    assert column(spark, values, lambda c: titles.find_title([c])) == ["부교수", "조교수", "임용교수", "전임강사", "교수", None, None]
    listed = column(spark, values, lambda c: titles.find_title([c], strict_title=False))
    assert listed == ["교수", "교수", "교수", "전임강사", "교수", None, None]


def test_title_fill(spark):
    df = spark.createDataFrame(
        [("", None, " ", None), ("S", "", "", None), ("", "", "", "교수"), ("S", "D", "T", "교수")],
        "school string, department string, title string, found string",
    )
    got = df.select(*titles.fill_title_fields(*[F.col(c) for c in df.columns])).collect()
    assert [tuple(r) for r in got] == [
        ("해당없음",) * 3, ("S", "해당없음", "해당없음"), ("", "", "교수"), ("S", "D", "T"),
    ]


def test_headers(spark):
    values = ["성 명", "소유주식수(의결권 있는 주식)", "소유\n주식(의결권X)", "의결권있는 주식", "소유주식수", "임기만료일", "Position", "비고"]
    assert column(spark, values, header_field) == [
        "name", "shares_voting", "shares_nonvoting", "shares_voting", None, "term_end", "position", None,
    ]
    arrays = [["성명", "직위"], ["성명"], ["홍길동", "이사"], None]
    assert column(spark, arrays, is_header, "array<string>") == [True, False, False, False]


def test_row_encoding_roundtrip(spark):
    cells = [["a", "", "c"], ["x\"y", "ㄱ"]]
    assert column(spark, cells, rows.row_text, "array<string>") == ["0: a | 2: c", "0: x\"y | 1: ㄱ"]
    back = column(spark, cells, lambda c: F.map_values(rows.parse_row(rows.row_json(c))), "array<string>")
    assert back == cells
    assert column(spark, cells, lambda c: rows.parse_columns(rows.columns_json(c)), "array<string>") == [["0", "1", "2"], ["0", "1"]]
    padded = column(spark, cells, lambda c: rows.pad_cells(c, F.lit(4)), "array<string>")
    assert padded == [["a", "", "c", ""], ["x\"y", "ㄱ", "", ""]]
    assert column(spark, [["a", None, " b "]], rows.clean_cells, "array<string>") == [["a", "", "b"]]


def test_drop_blank_entries(spark):
    values = [{"0": " a ", "1": None, "2": "　", "_회사": "x"}, {"1": " "}]
    assert column(spark, values, rows.drop_blank_entries, "map<string,string>") == [{"0": "a"}, {}]


def test_report_class_and_code(spark):
    values = ["[기재정정]분기보고서 (2023.03)", "반기보고서", "사업보고서", "연간", "감사보고서", ""]
    kinds = column(spark, values, reports.report_class)
    assert kinds == ["분기", "반기", "연간", "연간", None, None]
    assert column(spark, kinds, reports.report_code) == ["11013", "11012", "11011", "11011", None, None]


def test_window_edges(spark):
    days = ["20210101", "20210102", "20231231", "20240102", "20240103", None]  # 3 * 365 days back
    as_of = F.lit("2024-01-02").cast("date")
    assert column(spark, days, lambda c: reports.in_window(c, as_of, 3)) == [False, True, True, True, False, None]


def test_status_routes(spark):
    assert column(spark, ["000", "013", "014", "020", None], reports.response_route) == ["data", "empty", "empty", "error", "error"]


def test_canonical_headers():
    assert canonical_headers(["corp_eng_name", "corp_name", " 종목코드 ", "회사코드(8)"]) == {
        "corp_code": "회사코드(8)", "corp_name": "corp_name", "stock_code": " 종목코드 ",
    }
    assert canonical_headers(["CORP_CODE", "corp_eng_name", "stock_code"])["corp_name"] == "corp_eng_name"
    with pytest.raises(ValueError, match=r"\['corp_name', 'stock_code'\]"):
        canonical_headers(["corp_code", "x"])


def test_canonical_roster_nulls_stay_empty(spark):
    df = spark.createDataFrame([("126380.0 ", None, None, "k")], "`corp_code ` string, `회사명` string, stock_code string, more string")
    assert canonical_roster(df).collect()[0].asDict() == {"corp_code": "126380", "corp_name": "", "stock_code": "", "more": "k"}
