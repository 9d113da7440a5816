"""Queries on batches, landed files, increments and streams."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave import fixed_values as fv
from filingweave import schemas
from filingweave.functions.text import estimated_tokens
from filingweave.operators import batching, mapping, ordered
from filingweave.operators.keystore import KeyStore, pending_of
from filingweave.operators.pending import pending
from filingweave.plans.query_markup import ORDER, few, join_text
from filingweave.plans.registry import query, table
from filingweave.plans.staged import (
    REPORTS, choose_reports, collect, collected_rows, document_rows, export, map_rows, of_filings, reported,
)
from filingweave.session import scratch
from filingweave.sources.archives import read_archive_table, read_manifest, store_archives, unpack
from filingweave.sources.listings import (
    items_in_window, listing_items, listing_rejects, read_listing_table, read_listings, store_listings,
)
from filingweave.sources.tables import other_batches, read_or_empty, read_table, write_batch, write_table
from filingweave.streaming.files import NO_REPORT, stream_document_rows, stream_mapped_rows, waiting_rows


@query("""
SELECT role, conv_id, turn, CAST(floor((row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1) / 50) AS BIGINT) AS batch_no
FROM conversations""")
def batches_fixed(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("role", "conv_id", "turn")
    return batching.fixed_batches(rows, ["role"], ["conv_id", "turn"], size=50)


@query("""
WITH RECURSIVE r AS (SELECT role, conv_id, turn, length(text) * 2 AS est,
    row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn FROM conversations),
f AS (SELECT role, rn, 1 AS n, est AS total, CAST(0 AS BIGINT) AS batch_no FROM r WHERE rn = 1
  UNION ALL SELECT r.role, r.rn,
    CASE WHEN f.n >= 5 OR f.total + r.est > 1500 THEN 1 ELSE f.n + 1 END,
    CASE WHEN f.n >= 5 OR f.total + r.est > 1500 THEN r.est ELSE f.total + r.est END,
    f.batch_no + CASE WHEN f.n >= 5 OR f.total + r.est > 1500 THEN 1 ELSE 0 END
  FROM f JOIN r ON r.role = f.role AND r.rn = f.rn + 1)
SELECT role, conv_id, turn, batch_no FROM f JOIN r USING (role, rn)""")
def batches_greedy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(
        "role", "conv_id", "turn", estimated_tokens(F.col("text")).alias("est")
    )
    batched = batching.greedy_batches(
        rows, ["role"], ["conv_id", "turn"], F.col("est"), max_rows=5, max_cost=1500, chunk_rows=100_000
    )
    return batched.drop("est")


@query("""
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_no FROM events""")
def row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "event_id", "ts")
    day = F.unix_date(F.to_date("ts"))
    return ordered.numbered(events, ["event_type"], ["ts", "event_id"], chunk=day).drop("ts")


@query("""
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS company_id, CAST(0 AS INTEGER) AS listing_pos,
  o_orderpriority AS report_nm, CAST(o_orderkey AS VARCHAR) AS rcept_no, strftime(o_orderdate, '%Y%m%d') AS rcept_dt
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0'), CAST(1 AS INTEGER), NULL, o_orderkey || 'b', NULL
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0'), NULL, 'rejected', '020', CAST(o_orderkey AS VARCHAR)
FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def listing_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as one landed response of two items, written as JSON lines and read back."""
    status = F.when(F.col("o_orderstatus") == "F", "000").when(F.col("o_orderstatus") == "O", "013").otherwise("020")
    first = F.struct(
        F.col("o_orderpriority").alias("report_nm"),
        F.col("o_orderkey").cast("string").alias("rcept_no"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"),
    )
    second = F.struct(
        F.lit(None).cast("string").alias("report_nm"),
        F.concat("o_orderkey", F.lit("b")).alias("rcept_no"),
        F.lit(None).cast("string").alias("rcept_dt"),
    )
    responses = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("corp_code"), F.lit("A").alias("pblntf_ty"), status.alias("status"),
        F.col("o_orderkey").cast("string").alias("message"), F.lit(2).alias("total_count"),
        F.when(status == "000", F.array(first, second)).alias("list"),
    )
    folder = scratch(spark)
    responses.write.json(folder)
    landed = read_listings(spark, folder)
    items = listing_items(landed).select(
        "company_id", F.col("listing_pos.at").alias("listing_pos"), "report_nm", "rcept_no", "rcept_dt"
    )
    rejects = listing_rejects(landed).select(
        F.lpad("corp_code", 8, "0").alias("company_id"), F.lit(None).cast("int").alias("listing_pos"),
        F.lit("rejected").alias("report_nm"), F.col("status").alias("rcept_no"), F.col("message").alias("rcept_dt"),
    )
    return items.unionByName(rejects)


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'b-1' ELSE 'b-2' END AS batch FROM orders""")
def incremental_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two increments, the second over all orders and run twice: every order is there once."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    schema = orders.select("o_orderkey", "o_custkey").schema
    folder = scratch(spark)
    for batch, part in [("1", orders.where("o_orderstatus = 'F'")), ("2", orders), ("2", orders)]:
        done = other_batches(read_or_empty(spark, folder, schema), batch)
        todo = pending(part.drop("o_orderstatus"), done, ["o_orderkey"])
        write_batch(todo, folder, batch)
    return spark.read.schema(schema).parquet(folder)


STAGE = schemas.strings("code", "name", "note")


@query("""
WITH x AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, ' "' || c_name || '", ' || c_mktsegment || chr(10) || 'x ' AS name,
  CASE WHEN c_nationkey < 8 THEN NULL WHEN c_nationkey < 16 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS note FROM customer)
SELECT 'parquet' AS fmt, * FROM x UNION ALL SELECT 'csv', * FROM x
UNION ALL SELECT 'orders', lpad(CAST(o_orderkey AS VARCHAR), 14, '0'), o_orderpriority, NULL FROM orders""")
def stage_tables(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("c_nationkey")
    customers = table(spark, sf, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"),
        F.concat(F.lit(' "'), "c_name", F.lit('", '), "c_mktsegment", F.lit("\nx ")).alias("name"),
        F.when(n < 8, None).when(n < 16, "").otherwise(n.cast("string")).alias("note"),
    )
    orders = table(spark, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 14, "0").alias("code"), F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("string").alias("note"),
    )
    folder = scratch(spark)
    parts = []
    for name, df in [("customers.parquet", customers), ("customers.csv", customers), ("orders.csv", orders)]:
        write_table(df, f"{folder}/{name}")
        label = "orders" if name.startswith("orders") else name.rpartition(".")[2]
        parts.append(read_table(spark, f"{folder}/{name}", STAGE).select(F.lit(label).alias("fmt"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_EXPORTED = """
WITH m AS (SELECT c_custkey, c_name, o_orderpriority, o_orderstatus, o_orderkey, o_orderdate, lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS no
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
SELECT 'executive' AS sheet, c_name AS company, o_orderpriority AS a, CAST(year(o_orderdate) AS VARCHAR) AS b FROM (
  SELECT *, row_number() OVER (PARTITION BY c_name, o_orderpriority, year(o_orderdate) ORDER BY no) AS rn FROM m) WHERE rn = 1
UNION ALL SELECT 'summary', c_name, coalesce(t, '정보없음'), coalesce(u, '') FROM customer LEFT JOIN (
  SELECT c_custkey, arg_min(o_orderstatus, no) AS t, arg_min('u' || no, no) AS u FROM m GROUP BY c_custkey) USING (c_custkey)"""


def urgent_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers as roster, and finished urgent orders as mapping results."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    number = F.lpad(F.col("o_orderkey").cast("string"), 14, "0")
    year = F.year("o_orderdate").cast("string")
    results = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("company"), F.lit("").alias("stock_code"), F.col("o_orderstatus").alias("report_type"),
        F.concat(F.lit("u"), number).alias("url"),
        *[
            {"name": F.col("o_orderpriority"), "position": year, "duty": year}.get(f, F.lit("")).alias(f)
            for f in fv.RECORD_FIELDS
        ],
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("company_id"), number.alias("rcept_no"),
        F.lit(0).alias("source_xml_index"), F.lit(0).alias("row_index"), F.lit(1).alias("attempts"),
        F.lit(0.0).alias("latency_ms"), F.lit("").alias("error"),
    )
    roster = customers.select(
        F.col("c_custkey").cast("string").alias("corp_code"), F.col("c_name").alias("corp_name"), F.lit("").alias("stock_code")
    )
    return roster, results


def exported(spark: SparkSession, folder: str) -> DataFrame:
    """Both exported tables, read back."""
    sheet = spark.read.parquet(f"{folder}/export/executives.parquet")
    summary = spark.read.parquet(f"{folder}/export/company_summary.parquet")
    return sheet.select(
        F.lit("executive").alias("sheet"), F.col("회사").alias("company"), F.col("성명").alias("a"), F.col("담당업무").alias("b")
    ).unionByName(
        summary.select(F.lit("summary").alias("sheet"), F.col("회사").alias("company"), F.col("구분").alias("a"), F.col("url").alias("b"))
    )


@query(_EXPORTED)
def export_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Both exported tables, written under their labels and read back."""
    roster, results = urgent_orders(spark, sf)
    folder = scratch(spark)
    write_batch(mapping.mapped_rows(results, "rules"), f"{folder}/mapped", "1")
    export(spark, roster, folder, f"{folder}/export")
    return exported(spark, folder)


@query(_EXPORTED)
def export_increments(spark: SparkSession, sf: str) -> DataFrame:
    """An export after each of three increments, from state tables; the last one tells what one over all rows would."""
    roster, results = urgent_orders(spark, sf)
    folder = scratch(spark)
    mapped = mapping.mapped_rows(results, "rules")
    for batch in range(3):
        write_batch(mapped.where(F.pmod(F.crc32("rcept_no"), F.lit(3)) == batch), f"{folder}/mapped", str(batch))
        export(spark, roster, folder, f"{folder}/export")
    return exported(spark, folder)


def order_title() -> Column:
    """A report title by order priority; two of the five name no report class."""
    priority = F.col("o_orderpriority")
    kind = F.when(priority == "1-URGENT", "분기보고서").when(priority == "2-HIGH", "반기보고서")
    return join_text(kind.when(priority == "3-MEDIUM", "사업보고서").otherwise("기타 공시"), " (", F.year("o_orderdate"), ")")


def order_filing() -> Column:
    """A filing about each order: one person with a title, one without, and a nameless row."""
    return join_text(
        "<P>가. 임원의 현황</P><TABLE><THEAD><TR><TH>성 명</TH><TH>직위</TH><TH>담당 업무</TH><TH>주요경력</TH><TH>임기</TH></TR></THEAD>"
        "<TBODY><TR><TD>P", F.col("o_orderkey"), "</TD><TD>", F.col("o_orderstatus"), "</TD><TD>ㆍ", F.col("o_orderpriority"),
        "ㆍ자문</TD><TD>(현) U", F.col("o_custkey"), "대학교 경영학과 부교수</TD></TR><TR><TD>Q</TD><TD>이사</TD><TD>총괄</TD></TR>"
        "<TR><TD> </TD><TD>감사</TD></TR></TBODY></TABLE>",
    )


def stored_zip(entries: list[tuple[bytes, bytes]]) -> bytes:
    """An archive of (ASCII name, content), byte by byte as ``zipfile`` writes uncompressed ones; its objects cost most of the time on small ones."""
    parts, heads, at = [], [], 0
    for name, body in entries:
        told = struct.pack("<5H3I2H", 20, 0, 0, 0, 33, zlib.crc32(body), len(body), len(body), len(name), 0)  # 33: 1980-01-01
        parts += [b"PK\3\4", told, name, body]
        heads += [b"PK\1\2\x14\3", told, struct.pack("<3H2I", 0, 0, 0, 0o600 << 16, at), name]
        at += 30 + len(name) + len(body)
    size = sum(map(len, heads))
    return b"".join([*parts, *heads, b"PK\5\6", struct.pack("<4H2IH", 0, 0, len(entries), len(entries), size, at, 0)])


def zip_filings(filings: DataFrame) -> DataFrame:
    """(rcept_no, text) -> (rcept_no, content): an archive of an empty and a real document."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents = "<p>목차</p>".encode("euc-kr")
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, packed = batch.slice(at, 1000), []
                for text in part.column(1).to_pylist():
                    packed.append(stored_zip([(b"1.xml", text.encode("euc-kr")), (b"0.xml", contents)]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["rcept_no", "content"])

    return filings.select("rcept_no", "text").mapInArrow(pack, "rcept_no string, content binary")


_CHOSEN = """
WITH p AS (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS no, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderpriority, strftime(o_orderdate, '%Y%m%d') DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    AND o_orderdate >= DATE '1998-08-02' - 1095 AND o_orderdate < DATE '1998-08-03'),
c AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS company_id, c_name AS company,
    lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS stock_code,
    CASE o_orderpriority WHEN '1-URGENT' THEN '분기' WHEN '2-HIGH' THEN '반기' ELSE '연간' END AS report_type,
    'https://example.org/view?rcpNo=' || no AS url, no AS rcept_no, o_orderkey, o_custkey, o_orderstatus, o_orderpriority
  FROM p JOIN customer ON o_custkey = c_custkey WHERE rn = 1)"""
_MAPPED = _CHOSEN + """
SELECT company_id, company, stock_code, report_type, url, rcept_no, CAST(1 AS INTEGER) AS source_xml_index, CAST(0 AS INTEGER) AS row_index,
  'P' || o_orderkey AS name, o_orderstatus AS position, o_orderpriority || ', 자문' AS duty,
  'U' || o_custkey || '대학교' AS school, '경영학과' AS department, '부교수' AS prof_title FROM c
UNION ALL SELECT company_id, company, stock_code, report_type, url, rcept_no, CAST(1 AS INTEGER), CAST(1 AS INTEGER), 'Q', '이사', '총괄',
  '해당없음', '해당없음', '해당없음' FROM c"""
_VIEWER, _AS_OF = "https://example.org/view", "1998-08-02"


def landed_orders(spark: SparkSession, sf: str, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Roster, listings and archives: customers, and each order as a landed listing and as an archived filing."""
    roster = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("corp_code"), F.col("c_name").alias("corp_name"),
        F.col("c_nationkey").cast("string").alias("stock_code"),
    )
    orders = few(spark, sf, "orders", *ORDER)
    number = F.lpad(F.col("o_orderkey").cast("string"), 14, "0")
    item = F.struct(
        order_title().alias("report_nm"), number.alias("rcept_no"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"),
    )
    orders.select(
        F.col("o_custkey").cast("string").alias("corp_code"), F.lit("A").alias("pblntf_ty"), F.lit("000").alias("status"),
        F.array(item).alias("list"),
    ).write.json(f"{folder}/listings")
    filings = orders.select(number.alias("rcept_no"), order_filing().alias("text"), "o_orderstatus")
    return roster, read_listings(spark, f"{folder}/listings"), filings


def mapped_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.MAPPED).parquet(f"{folder}/mapped").select(
        "company_id", "company", "stock_code", "report_type", "url", "rcept_no", "source_xml_index", "row_index",
        "name", "position", "duty", "school", "department", "prof_title",
    )


@query(_MAPPED)
def staged_run(spark: SparkSession, sf: str) -> DataFrame:
    """Collect and map: customers as roster, each order as a landed listing and as an archived filing."""
    folder = scratch(spark)
    roster, listings, filings = landed_orders(spark, sf, folder)
    numbers = filings.select("rcept_no")
    collect(spark, roster, listings, zip_filings(filings), folder, _VIEWER, _AS_OF, batch="1", landed=numbers)
    map_rows(spark, folder, batch="1")
    return mapped_table(spark, folder)


@query(_CHOSEN + """
SELECT 'collected' AS state, company_id, company, report_type, url, rcept_no, CAST(i AS INTEGER) AS row_index,
  CASE i WHEN 0 THEN 'P' || o_orderkey WHEN 1 THEN 'Q' ELSE '' END AS person FROM c, range(3) AS r(i)
UNION ALL SELECT 'no report yet', NULL, NULL, NULL, NULL, lpad(CAST(o_orderkey AS VARCHAR), 14, '0'), NULL, NULL
FROM orders WHERE lpad(CAST(o_orderkey AS VARCHAR), 14, '0') NOT IN (SELECT rcept_no FROM c)""")
def stream_collect(spark: SparkSession, sf: str) -> DataFrame:
    """Archives as a stream of landed tables, half of them before their reports: each row once, the others wait."""
    folder = scratch(spark)
    roster, listings, filings = landed_orders(spark, sf, folder)
    write_table(choose_reports(roster, listings, _VIEWER, _AS_OF), f"{folder}/reports")
    reports = spark.read.schema(REPORTS).parquet(f"{folder}/reports")
    early = reports.where(F.crc32("rcept_no") % 2 == 0)
    for landing, known in ((0, early), (1, early), (None, reports)):
        if landing is not None:
            store_archives(zip_filings(filings.where(F.crc32("rcept_no") % 3 % 2 == landing)), f"{folder}/archives")
        stream_document_rows(
            spark, f"{folder}/archives", known, folder, f"{folder}/state", run="s", table=True
        ).awaitTermination()
    rows = spark.read.schema(schemas.COLLECTED).parquet(f"{folder}/collected").select(
        F.lit("collected").alias("state"), "company_id", "company", "report_type", "url", "rcept_no", "row_index",
        F.get_json_object("row_json", "$.0").alias("person"),
    )
    waiting = waiting_rows(spark, folder).select("rcept_no").distinct().withColumn("state", F.lit(NO_REPORT))
    return rows.unionByName(waiting, allowMissingColumns=True)


@query(_CHOSEN + """
SELECT 'item' AS kind, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS company_id, lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS rcept_no
FROM orders WHERE o_orderdate >= DATE '1998-08-02' - 1095 AND o_orderdate < DATE '1998-08-03'
UNION ALL SELECT 'chosen', company_id, rcept_no FROM c""")
def listing_window(spark: SparkSession, sf: str) -> DataFrame:
    """Listings landed once in a table by receipt month: a window's items, and the reports chosen from them."""
    folder = scratch(spark)
    roster, listings, _ = landed_orders(spark, sf, folder)
    store_listings(listings, f"{folder}/items")
    landed = read_listing_table(spark, f"{folder}/items")
    items = items_in_window(landed, _AS_OF, 3).select(F.lit("item").alias("kind"), "company_id", "rcept_no")
    chosen = choose_reports(roster, landed, _VIEWER, _AS_OF)
    return items.unionByName(chosen.select(F.lit("chosen").alias("kind"), "company_id", "rcept_no"))


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey % 4 = 3 OR (l_orderkey % 4 = 2 AND l_linenumber > 3)""")
def pending_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines that no earlier increment has: three increments are kept as bucketed keys, the last is being made anew."""
    folder = scratch(spark)
    keys = {"l_orderkey": "bigint", "l_linenumber": "int"}
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"), "l_suppkey")
    for batch, part in (("1", "l_orderkey % 4 = 0"), ("2", "l_orderkey % 4 = 1"), ("3", "l_orderkey % 4 = 2 AND l_linenumber <= 3"), ("4", "l_orderkey % 4 = 3")):
        write_batch(lines.where(part), f"{folder}/done", batch)
    store = KeyStore(spark, f"{folder}/keys", list(keys), list(keys.values()))
    for batch in ("3", "4"):
        store.follow(f"{folder}/done", lambda path: spark.read.schema("l_orderkey bigint, l_linenumber int").parquet(path), batch)
    return pending_of(lines, [store])


@query(_MAPPED)
def stream_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows mapped as a file stream, run to its end twice: the second run finds nothing new."""
    folder = scratch(spark)
    roster, listings, filings = landed_orders(spark, sf, folder)
    numbers = filings.select("rcept_no")
    collect(spark, roster, listings, zip_filings(filings), folder, _VIEWER, _AS_OF, batch="1", landed=numbers)
    for _ in range(2):
        stream_mapped_rows(spark, f"{folder}/collected", folder, f"{folder}/state", run="s").awaitTermination()
    return mapped_table(spark, folder)


@query(_CHOSEN + """
SELECT company_id, company, rcept_no, CASE o_orderstatus WHEN 'O' THEN 'bad archive' ELSE 'no archive' END AS error
FROM c WHERE o_orderstatus <> 'F'""")
def archive_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Filings that cannot be read, and reports whose archive has not landed."""
    folder = scratch(spark)
    roster, listings, filings = landed_orders(spark, sf, folder)
    broken = filings.where("o_orderstatus = 'O'").select("rcept_no", F.lit("PK broken").cast("binary").alias("content"))
    archives = zip_filings(filings.where("o_orderstatus = 'F'")).unionByName(broken)
    store_archives(archives, f"{folder}/archives")
    archives, numbers = read_archive_table(spark, f"{folder}/archives"), read_manifest(spark, f"{folder}/archives")
    collect(spark, roster, listings, archives, folder, _VIEWER, _AS_OF, batch="1", landed=numbers)
    rejects = spark.read.schema(schemas.ARCHIVE_REJECTS).parquet(f"{folder}/archive_rejects")
    return rejects.select("company_id", "company", "rcept_no", F.substring_index("error", ":", 1).alias("error"))


@query(_CHOSEN + """
SELECT company_id, rcept_no, CAST(i AS INTEGER) AS row_index, CASE i WHEN 2 THEN 'no name' ELSE '' END AS error, CAST(1 AS BIGINT) AS times
FROM c, range(3) AS r(i)""")
def incremental_map(spark: SparkSession, sf: str) -> DataFrame:
    """Three increments of mapping: every row has one outcome, rejects too."""
    folder = scratch(spark)
    roster, listings, filings = landed_orders(spark, sf, folder)
    numbers = filings.select("rcept_no")
    collect(spark, roster, listings, zip_filings(filings), folder, _VIEWER, _AS_OF, batch="1", landed=numbers)
    for batch in ("1", "2", "3"):
        map_rows(spark, folder, batch=batch)
    key = ["company_id", "rcept_no", "row_index", "error"]
    mapped = spark.read.schema(schemas.MAPPED).parquet(f"{folder}/mapped").select(*key)
    rejected = spark.read.schema(schemas.REJECTED).parquet(f"{folder}/rejected").select(*key)
    return mapped.union(rejected).groupBy(*key).agg(F.count(F.lit(1)).alias("times"))


def _answer(prompt: str) -> str:
    """A service that echoes the row's first cell as the name."""
    row = json.loads(re.search(r"Row: (.*)", prompt)[1])
    return json.dumps({"성명": row["0"], "직위": row.get("1", ""), "담당업무": len(row)})


@query(_CHOSEN + """
SELECT company_id, rcept_no, CAST(0 AS INTEGER) AS row_index, 'P' || o_orderkey AS name, o_orderstatus AS position, 'hook' AS llm_model FROM c
UNION ALL SELECT company_id, rcept_no, CAST(1 AS INTEGER), 'Q', '이사', 'hook' FROM c""")
def service_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """A hook asked once a row, its answers committed in parts; the second run asks nothing."""
    folder = scratch(spark)
    roster, listings, filings = landed_orders(spark, sf, folder)
    numbers = filings.select("rcept_no")
    collect(spark, roster, listings, zip_filings(filings), folder, _VIEWER, _AS_OF, batch="1", landed=numbers)
    for batch in ("1", "2"):
        map_rows(spark, folder, batch, ask=_answer, partitions=8, model="hook", units=2)
    mapped = spark.read.schema(schemas.MAPPED).parquet(f"{folder}/mapped")
    return mapped.select("company_id", "rcept_no", "row_index", "name", "position", "llm_model")


@query("""
SELECT c_name AS company, '정보없음' AS report_type, '' AS url, CAST(0 AS BIGINT) AS executives FROM customer""")
def empty_export(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing mapped: the summary lists every company without information, the sheet keeps its columns."""
    roster = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("corp_code"), F.col("c_name").alias("corp_name"), F.lit("").alias("stock_code")
    )
    folder = scratch(spark)
    export(spark, roster, folder, f"{folder}/export")
    sheet = spark.read.parquet(f"{folder}/export/executives.parquet").select(*fv.EXECUTIVE_LABELS.values())
    summary = spark.read.parquet(f"{folder}/export/company_summary.parquet")
    return summary.select(
        F.col("회사").alias("company"), F.col("구분").alias("report_type"), "url", F.lit(sheet.count()).cast("long").alias("executives")
    )


@query("""
SELECT strftime(o_orderdate, '%Y') || '0101' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS rcept_no, CAST(o_custkey AS VARCHAR) AS company,
  CAST(1 AS INTEGER) AS source_xml_index, CAST(i AS INTEGER) AS row_index, CASE i WHEN 0 THEN 'P' || o_orderkey WHEN 1 THEN 'Q' ELSE '' END AS person
FROM orders, range(3) AS r(i) WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 1995""")
def report_archive_join(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of some years against an archive table of all days: other days' files are not opened."""
    number = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("0101"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    orders = few(spark, sf, "orders", *ORDER).withColumn("rcept_no", number)
    folder = scratch(spark)
    store_archives(zip_filings(orders.select("rcept_no", order_filing().alias("text"))), folder)
    wanted = orders.where((F.col("o_orderstatus") == "F") & (F.year("o_orderdate") >= 1995))
    company = F.col("o_custkey").cast("string").alias("company")
    reports = wanted.select("rcept_no", company, *[F.lit("").alias(c) for c in REPORTS.names if c not in ("rcept_no", "company")])
    archives = of_filings(read_archive_table(spark, folder), reports)
    rows = collected_rows(reported(document_rows(unpack(archives)), reports))
    person = F.get_json_object("row_json", "$.0").alias("person")
    return rows.select("rcept_no", "company", "source_xml_index", "row_index", person)
