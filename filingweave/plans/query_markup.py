"""Queries that render table rows as markup or archives and read them back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.functions import rows as R
from filingweave.operators import markup
from filingweave.plans.registry import query, table
from filingweave.session import scratch, spread
from filingweave.sources.archives import read_archives, readable, unpack


def few(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, over all cores: rendering and parsing outweigh moving these."""
    return spread(table(spark, sf, name).select(*columns))


ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
CUSTOMER = ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]


def join_text(*parts: Column | str) -> Column:
    """Literals and columns, concatenated; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def text_rows(documents: DataFrame, key: str, **options) -> DataFrame:
    rows = markup.encode_rows(markup.extract_rows(documents, **options))
    return rows.select(key, "row_index", "row_text")


ORDER_TABLE_SQL = """
SELECT o_orderkey, CAST(0 AS INTEGER) AS row_index, '0: ' || o_orderkey || ' | 1: ' || o_orderstatus AS row_text FROM orders
UNION ALL SELECT o_orderkey, CAST(1 AS INTEGER), '0: ' || o_orderpriority || ' | 2: ' || strftime(o_orderdate, '%Y%m%d') || ' | 3: ' || o_custkey
FROM orders"""


def order_document(heading: Column | str = "<P>가. 임원의 현황</P>") -> Column:
    return join_text(
        heading,
        "<table><thead><tr><th>성명</th><th>직위</th><th>임기</th></tr></thead>\n<tbody>",
        "<tr><td>", F.col("o_orderkey"), "</td><td>&nbsp;", F.col("o_orderstatus"), "</td></tr>",
        "<tr><td> </td><td>　</td></tr><tr><th>계</th></tr>",
        "<TR><TD>", F.substring("o_orderpriority", 1, 2), "<br><b>", F.expr("substring(o_orderpriority, 3)"),
        "</b></TD><td></td><td>", F.date_format("o_orderdate", "yyyyMMdd"), "</td><td>", F.col("o_custkey"),
        "<!-- end --></td></TR></tbody></table>",
    )


@query(ORDER_TABLE_SQL)
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    docs = few(spark, sf, "orders", *ORDER).select("o_orderkey", order_document().alias("xml_text"))
    return text_rows(docs, "o_orderkey")


@query(ORDER_TABLE_SQL)
def squashed_headings(spark: SparkSession, sf: str) -> DataFrame:
    """Headings with entity blanks and quotes inside, found on text without blanks and quotes."""
    status = F.col("o_orderstatus")
    heading = F.when(status == "F", "<P>가.&nbsp;임원의&nbsp;현황</P>").when(status == "O", "<P>가.\u00a0&quot;임원의&quot;\u00a0현황</P>")
    docs = few(spark, sf, "orders", *ORDER).select(
        "o_orderkey", order_document(heading.otherwise("<P>가. 임원의 현 황</P>")).alias("xml_text")
    )
    return text_rows(docs, "o_orderkey", squash_headings=True)


FULL_HEADER = "<tr><td>성 명</td><td>성별</td><td>출생년월</td><td>직위</td><td>등기임원</td><td>상근</td></tr>"


def customer_document() -> Column:
    """Three layouts: a roster among decoys, only a concurrent-posts table, no acceptable table."""
    decoy = f"<table>{FULL_HEADER}<tr><td>decoy</td></tr></table>"
    concurrent = join_text(
        "<p>나. 등기임원의 타회사 겸직 현황</p><table>", FULL_HEADER,
        "<tr><td>", F.col("c_custkey"), "</td><td>겸직</td></tr></table>",
    )
    real = join_text(
        "<div><p>가. 등기임원</p><table><thead><tr><th>x</th></tr></thead>", FULL_HEADER,
        "<tr><td>", F.col("c_name"), "</td><td>", F.col("c_mktsegment"), "</td></tr></table></div>",
    )
    plain = join_text("<p>가. 등기임원</p><table><tr><td>", F.col("c_name"), "</td><td>성명</td></tr></table>")
    n = F.col("c_nationkey")
    return (
        F.when(n < 10, F.concat(F.lit(decoy), concurrent, real)).when(n < 20, concurrent).otherwise(plain)
    )


@query("""
SELECT c_custkey, CAST(0 AS INTEGER) AS row_index, '0: 성 명 | 1: 성별 | 2: 출생년월 | 3: 직위 | 4: 등기임원 | 5: 상근' AS row_text
FROM customer WHERE c_nationkey < 20
UNION ALL SELECT c_custkey, CAST(1 AS INTEGER), '0: ' || CASE WHEN c_nationkey < 10 THEN c_name || ' | 1: ' || c_mktsegment
  ELSE c_custkey || ' | 1: 겸직' END FROM customer WHERE c_nationkey < 20""")
def best_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    docs = few(spark, sf, "customer", *CUSTOMER).select("c_custkey", customer_document().alias("xml_text"))
    return text_rows(docs, "c_custkey")


@query("""
SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 110 WHEN c_nationkey < 20 THEN 40 END AS score,
  CASE WHEN c_nationkey < 10 THEN 1 WHEN c_nationkey < 20 THEN 3 END AS keyword_index FROM customer""")
def table_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = few(spark, sf, "customer", *CUSTOMER).select("c_custkey", customer_document().alias("xml_text"))
    nodes = docs.select("c_custkey", markup.markup_nodes(F.col("xml_text")).alias("n"))
    return nodes.select("c_custkey", markup.best_table(F.col("n")).alias("b")).select(
        "c_custkey", F.col("b.score").alias("score"), (-F.col("b.rank")).alias("keyword_index")
    )


@query("""
SELECT c_custkey, CAST(0 AS INTEGER) AS row_index, '0: 성명 | 1: 직위 | 2: 임기' AS row_text FROM customer
UNION ALL SELECT c_custkey, CAST(1 AS INTEGER), '0: ' || array_to_string(list_filter(
  [c_name, CASE WHEN c_nationkey < 12 THEN '' ELSE c_mktsegment END], lambda x: x <> ''), ' | 1: ') FROM customer
UNION ALL SELECT c_custkey, CAST(2 AS INTEGER), '0: ' || c_custkey FROM customer""")
def fallback_cells(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.when(F.col("c_nationkey") < 12, " ").otherwise(F.col("c_mktsegment"))
    doc = join_text(
        "<p>가. 임원 현황</p><table><tr><tu>성명</tu><tu>직위</tu><tu>임기</tu></tr><tr><tu/><te>", F.col("c_name"),
        "</te><tu>", segment, "</tu></tr><tr></tr><tr><tu>ignored</tu><td>", F.col("c_custkey"), "</td></tr></table>",
    )
    return text_rows(few(spark, sf, "customer", *CUSTOMER).select("c_custkey", doc.alias("xml_text")), "c_custkey")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS xml_index, row_index, row_text
FROM orders JOIN (""" + ORDER_TABLE_SQL + """) USING (o_orderkey)""")
def first_document_table(spark: SparkSession, sf: str) -> DataFrame:
    texts = [
        F.lit("<p>가. 임원의 현황</p><p>표 없음</p>"),
        F.when(F.col("o_orderstatus") == "F", order_document()).otherwise("<table></table>"),
        order_document("<p>1. 등기임원</p>"),
    ]
    entries = F.array(*[F.struct(F.lit(i).alias("xml_index"), t.alias("xml_text")) for i, t in enumerate(texts)])
    docs = few(spark, sf, "orders", *ORDER).select("o_orderkey", F.explode(entries).alias("d")).select("o_orderkey", "d.*")
    rows = markup.encode_rows(markup.extract_rows(docs, first_of=["o_orderkey"]))
    return rows.select("o_orderkey", "xml_index", "row_index", "row_text")


@query(r"""
SELECT page_id, CAST(len(list_filter(
    regexp_extract_all(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|>[^<]+'),
    lambda m: contains(m, 'the') OR contains(m, 'que') OR contains(m, 'der'))) AS INTEGER) AS n_nodes
FROM pages""")
def page_text_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = markup.markup_nodes(F.col("html"), ["the", "que", "der"])
    return few(spark, sf, "pages", "page_id", "html").select("page_id", nodes.alias("n")).select(
        "page_id", F.size("n.texts").alias("n_nodes")
    )


@query("""
SELECT c_custkey, '0' AS name, c_name AS value FROM customer UNION ALL SELECT c_custkey, '1', c_mktsegment FROM customer
UNION ALL SELECT c_custkey, '2', CASE WHEN c_nationkey < 9 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END FROM customer""")
def row_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    cells = R.clean_cells(customer_cells())
    encoded = table(spark, sf, "customer").select(
        "c_custkey", R.row_json(cells).alias("row_json"), R.columns_json(cells).alias("columns_json")
    )
    decoded = encoded.select(
        "c_custkey", R.parse_row(F.col("row_json")).alias("row"),
        F.explode(R.parse_columns(F.col("columns_json"))).alias("name"),
    )
    return decoded.select("c_custkey", "name", F.element_at("row", F.col("name")).alias("value"))


def customer_cells() -> Column:
    nation = F.when(F.col("c_nationkey") >= 9, F.col("c_nationkey").cast("string"))
    return F.array(F.concat(F.lit(" "), "c_name"), F.concat("c_mktsegment", F.lit("\n")), nation)


@query("""
SELECT c_custkey, '0: ' || c_name || ' | 1: ' || c_mktsegment ||
  CASE WHEN c_nationkey < 9 THEN '' ELSE ' | 2: ' || c_nationkey END AS row_text FROM customer""")
def row_text(spark: SparkSession, sf: str) -> DataFrame:
    cells = R.clean_cells(customer_cells())
    return table(spark, sf, "customer").select("c_custkey", R.row_text(cells).alias("row_text"))


@query("""
SELECT c_custkey, CASE WHEN c_nationkey < 9 THEN '0' WHEN c_mktsegment = 'BUILDING' THEN '0,2' ELSE '0,1,2' END AS kept,
  c_name AS first FROM customer WHERE c_nationkey <> 20""")
def drop_blank_cells(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("c_nationkey")
    row = F.create_map(
        F.lit("0"), F.when(n != 20, F.concat(F.lit("\t"), "c_name")),
        F.lit("1"), F.when((n >= 9) & (n != 20) & (F.col("c_mktsegment") != "BUILDING"), F.col("c_mktsegment")).otherwise("　"),
        F.lit("2"), F.when((n >= 9) & (n != 20), n.cast("string")),
        F.lit("_회사"), F.col("c_name"),
    )
    kept = table(spark, sf, "customer").select("c_custkey", R.drop_blank_entries(row).alias("row")).where(F.size("row") > 0)
    return kept.select(
        "c_custkey", F.array_join(F.array_sort(F.map_keys("row")), ",").alias("kept"),
        F.try_element_at("row", F.lit("0")).alias("first"),
    )


def zip_documents(documents: DataFrame, key: str) -> DataFrame:
    """(key, text, lang) -> an archive of three entries, stored out of name order, one of them EUC-KR."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part, packed = batch.slice(at, 100), []
                for text, lang in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    body = io.BytesIO()
                    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
                        z.writestr("b.xml", text.encode("utf-8"))
                        z.writestr("c.xml", b"\xff\xfe" + lang.encode())
                        z.writestr("a.xml", f"언어: {lang}".encode("euc-kr"))
                    packed.append(body.getvalue())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["rcept_no", "content"])

    keyed = documents.select(F.col(key).cast("string").alias("rcept_no"), "text", "lang")
    return keyed.mapInArrow(pack, "rcept_no string, content binary")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS rcept_no, CAST(0 AS INTEGER) AS xml_index, '언어: ' || lang AS xml_text FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), CAST(1 AS INTEGER), '€' || text FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), CAST(2 AS INTEGER), lang FROM documents""")
def archive_unpack(spark: SparkSession, sf: str) -> DataFrame:
    # the euro sign's bytes are no EUC-KR, so the text falls through to UTF-8
    docs = few(spark, sf, "documents", "doc_id", "text", "lang").withColumn("text", F.concat(F.lit("€"), "text"))
    return readable(unpack(zip_documents(docs, "doc_id")))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_mktsegment AS segment FROM customer""")
def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One table a line, many lines a file, the files read as binary archives of plain documents."""
    line = join_text(
        "<table><tr><td>", F.col("c_custkey"), "</td><td>", F.col("c_name"), "</td><td>", F.col("c_mktsegment"), "</td></tr></table>",
    )
    folder = scratch(spark)
    few(spark, sf, "customer", *CUSTOMER).select(line.alias("value")).write.option("maxRecordsPerFile", 500).text(folder)
    documents = readable(unpack(read_archives(spark, folder), plain_documents=True))
    nodes = documents.select(markup.markup_nodes(F.col("xml_text"), ["임원"]).alias("n"))
    tables = nodes.select(F.explode("n.tables").alias("t"))
    cells = tables.select(F.explode(markup.table_data(F.col("t"))).alias("c"))
    return cells.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(["code", "name", "segment"])])
