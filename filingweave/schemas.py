"""Explicit schemas: codes stay text, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from filingweave import fixed_values as fv


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ROSTER = strings("corp_code", "corp_name", "stock_code")

LISTING_ITEM = strings("report_nm", "rcept_no", "rcept_dt", "bsns_year")
LISTING = T.StructType(
    [
        *strings("corp_code", "pblntf_ty", "status", "message").fields,
        T.StructField("page_no", T.IntegerType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("list", T.ArrayType(LISTING_ITEM)),
    ]
)

LISTING_TABLE = T.StructType(
    [
        T.StructField("company_id", T.StringType()),
        T.StructField(
            "listing_pos", T.StructType([T.StructField("page", T.IntegerType()), T.StructField("at", T.IntegerType())])
        ),
        *LISTING_ITEM.fields,
        T.StructField("receipt_month", T.StringType()),
    ]
)
LISTING_FAILURES = T.StructType(
    [T.StructField("corp_code", T.StringType()), T.StructField("page_no", T.IntegerType()), *strings("status", "message").fields]
)

DOCUMENT = T.StructType(
    [
        T.StructField("rcept_no", T.StringType()),
        T.StructField("xml_index", T.IntegerType()),
        T.StructField("entry", T.StringType()),
        T.StructField("xml_text", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

COLLECTED = T.StructType(
    [
        *strings("company_id", "company", "stock_code", "report_type", "url", "rcept_no").fields,
        T.StructField("xml_index", T.IntegerType()),
        T.StructField("source_xml_index", T.IntegerType()),
        T.StructField("table_hint", T.StringType()),
        T.StructField("row_index", T.IntegerType()),
        *strings("columns_json", "row_json", "row_text", "header_json", "fields_json").fields,
        T.StructField("collected_at", T.TimestampType()),
    ]
)

ARCHIVE_REJECTS = T.StructType(
    [
        *strings("company_id", "company", "rcept_no", "entry").fields,
        T.StructField("xml_index", T.IntegerType()),
        *strings("error").fields,
    ]
)

SOURCE_KEY = ["company_id", "rcept_no", "source_xml_index", "row_index"]

RECORD = strings(*fv.RECORD_FIELDS)

MAPPED = T.StructType(
    [
        *strings("company", "stock_code", "report_type", "url").fields,
        *RECORD.fields,
        T.StructField("company_id", T.StringType()),
        T.StructField("rcept_no", T.StringType()),
        T.StructField("source_xml_index", T.IntegerType()),
        T.StructField("row_index", T.IntegerType()),
        T.StructField("llm_model", T.StringType()),
        T.StructField("llm_latency_ms", T.DoubleType()),
        T.StructField("llm_attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)

REJECTED = T.StructType(
    [
        *strings("company_id", "rcept_no").fields,
        T.StructField("source_xml_index", T.IntegerType()),
        T.StructField("row_index", T.IntegerType()),
        *strings("row_text").fields,
        T.StructField("attempts", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        *strings("error").fields,
        T.StructField("final", T.BooleanType()),
    ]
)

SUMMARY = strings(*fv.SUMMARY_LABELS)
EXECUTIVES = strings(*fv.EXECUTIVE_LABELS)
