"""Queries on codes, text, classes and headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.functions import codes, text
from filingweave.functions.headers import header_field
from filingweave.functions.titles import affiliation, fill_title_fields, find_title
from filingweave.operators import reports
from filingweave.operators.best_match import keyword_hits as hits_of
from filingweave.operators.grouped import value_counts as counts_of
from filingweave.operators.merge import named_only as named, union_missing as union_by_name
from filingweave.operators.merge import with_columns_present
from filingweave.plans.registry import query, table
from filingweave.sources.roster import canonical_roster


@query("""
WITH raw AS (
  SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN '  ' WHEN c_nationkey = 4 THEN NULL
    ELSE CAST(c_custkey * 97003 AS VARCHAR) END AS d FROM customer)
SELECT c_custkey,
  CASE WHEN coalesce(trim(d), '') = '' THEN '' WHEN length(d) >= 8 THEN d ELSE lpad(d, 8, '0') END AS company_id,
  CASE WHEN coalesce(trim(d), '') = '' THEN '' WHEN length(d) >= 6 THEN d ELSE lpad(d, 6, '0') END AS stock_code
FROM raw""")
def code_normalize(spark: SparkSession, sf: str) -> DataFrame:
    number = F.concat(F.lit("\t C-"), F.col("c_custkey") * 97003, F.lit(".0 "))
    raw = F.when(F.col("c_nationkey") == 3, " 　").when(F.col("c_nationkey") != 4, number)
    return table(spark, sf, "customer").select(
        "c_custkey", codes.company_code(raw).alias("company_id"), codes.stock_code(raw).alias("stock_code")
    )


@query("""
SELECT CASE WHEN length(CAST(event_id * 12345 AS VARCHAR)) <= 8 THEN 'valid' ELSE 'invalid' END AS status,
  count(*) AS n FROM events GROUP BY 1""")
def code_status(spark: SparkSession, sf: str) -> DataFrame:
    code = codes.company_code(F.concat(F.lit("A"), F.col("event_id") * 12345))
    marked = table(spark, sf, "events").select(
        F.when(codes.is_company_code(code), "valid").otherwise("invalid").alias("status")
    )
    return counts_of(marked, "status")


@query(r"""
SELECT doc_id, regexp_replace(text, '[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}"'']', '', 'g') AS squashed FROM documents""")
def text_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.squash(F.col("text")).alias("squashed"))


WORDS = ["the", "tion", "que", "der", "les", "est", "und", "ent", "sch", "eau", "ing", "heit", "on", "ver"]


@query("""
SELECT doc_id,
  CAST(list_sum(list_transform(['the','tion','que','der','les','est','und','ent','sch','eau','ing','heit','on','ver'],
    lambda w: CASE WHEN contains(text, w) THEN 1 ELSE 0 END)) AS INTEGER) AS n_tokens,
  contains(text, 'the') AND contains(text, 'tion') AND contains(text, 'ing') AS has_all
FROM documents""")
def token_count(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.token_count(body, WORDS).alias("n_tokens"),
        text.contains_all(body, ["the", "tion", "ing"]).alias("has_all"),
    )


@query("""
SELECT doc_id, CASE
  WHEN NOT (contains(text, 'tion') OR contains(text, 'heit') OR contains(text, 'que')) THEN ''
  WHEN contains(text, 'ention') THEN 'ention' WHEN contains(text, 'ation') THEN 'ation'
  WHEN contains(text, 'que ') THEN 'que ' ELSE 'other' END AS hint
FROM documents""")
def hint_class(spark: SparkSession, sf: str) -> DataFrame:
    hint = text.document_hint(F.col("text"), ["ention", "ation", "que "], "other", ["tion", "heit", "que"])
    return table(spark, sf, "documents").select("doc_id", hint.alias("hint"))


@query("""
WITH titled AS (
  SELECT o_orderkey, '[기재정정]' || CASE o_orderpriority WHEN '1-URGENT' THEN '분기보고서' WHEN '2-HIGH' THEN '반기보고서'
    WHEN '3-MEDIUM' THEN '사업보고서' WHEN '5-LOW' THEN '연간' ELSE '감사보고서' END
    || ' (' || CAST(year(o_orderdate) AS VARCHAR) || '.03)' AS report_nm FROM orders)
SELECT o_orderkey, report_nm,
  CASE WHEN contains(report_nm, '분기') THEN '분기' WHEN contains(report_nm, '반기') THEN '반기'
    WHEN contains(report_nm, '사업보고서') OR contains(report_nm, '연간') THEN '연간' END AS report_type,
  CASE WHEN contains(report_nm, '분기') THEN '11013' WHEN contains(report_nm, '반기') THEN '11012'
    WHEN contains(report_nm, '사업보고서') OR contains(report_nm, '연간') THEN '11011' END AS reprt_code
FROM titled""")
def report_classify(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "1-URGENT", "분기보고서").when(priority == "2-HIGH", "반기보고서")
        .when(priority == "3-MEDIUM", "사업보고서").when(priority == "5-LOW", "연간").otherwise("감사보고서")
    )
    title = F.concat(F.lit("[기재정정]"), kind, F.lit(" ("), F.year("o_orderdate"), F.lit(".03)"))
    typed = table(spark, sf, "orders").select("o_orderkey", title.alias("report_nm")).withColumn(
        "report_type", reports.report_class(F.col("report_nm"))
    )
    return typed.withColumn("reprt_code", reports.report_code(F.col("report_type")))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'data' WHEN 'O' THEN 'empty' ELSE 'error' END AS route
FROM orders""")
def status_routing(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "000").when(F.col("o_orderstatus") == "O", "013").otherwise("020")
    return table(spark, sf, "orders").select("o_orderkey", reports.response_route(status).alias("route"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts_of(table(spark, sf, "orders"), "o_orderpriority")


@query("""
SELECT doc_id, n_chars FROM documents WHERE lang <> 'de' AND source <> 'src1' AND trim(text) <> ''""")
def named_only(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("lang") == "de", "\t　 ").when(F.col("source") != "src1", F.col("text"))
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", name.alias("name"))
    return named(docs).select("doc_id", "n_chars")


@query("""
SELECT doc_id, CASE WHEN contains(text, 'tion') THEN 'tion' WHEN contains(text, 'ention') THEN 'ention'
    WHEN contains(text, 'schen') THEN 'schen' END AS listed,
  CASE WHEN contains(text, 'ention') THEN 'ention' WHEN contains(text, 'schen') THEN 'schen'
    WHEN contains(text, 'tion') THEN 'tion' END AS strict,
  CASE WHEN lang = 'en' THEN lang WHEN contains(text, 'tion') OR contains(text, 'schen') THEN '' ELSE '해당없음' END AS school,
  CASE WHEN contains(text, 'tion') OR contains(text, 'schen') THEN source ELSE source END AS department,
  CASE WHEN contains(text, 'ention') THEN 'ention' WHEN contains(text, 'schen') THEN 'schen'
    WHEN contains(text, 'tion') THEN 'tion' ELSE '해당없음' END AS title
FROM documents""")
def title_rules(spark: SparkSession, sf: str) -> DataFrame:
    titles = ["tion", "ention", "schen"]
    body = F.col("text")
    strict = find_title([body], titles)
    school, department, title = fill_title_fields(
        F.when(F.col("lang") == "en", F.col("lang")), F.col("source"), F.lit(" "), strict
    )
    return table(spark, sf, "documents").select(
        "doc_id",
        find_title([body], titles, strict_title=False).alias("listed"),
        strict.alias("strict"),
        school.alias("school"),
        department.alias("department"),
        title.alias("title"),
    )


@query("""
SELECT conv_id, turn, CASE WHEN contains(a, 'ention') THEN 'ention' WHEN contains(a, 'schen') THEN 'schen'
    WHEN contains(a, 'tion') THEN 'tion' WHEN contains(b, 'ention') THEN 'ention'
    WHEN contains(b, 'schen') THEN 'schen' WHEN contains(b, 'tion') THEN 'tion' END AS title
FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE '' END AS a, text AS b FROM conversations)""")
def title_precedence(spark: SparkSession, sf: str) -> DataFrame:
    duty = F.when(F.col("role") == "user", F.col("text")).otherwise("")
    title = find_title([duty, F.col("text")], ["tion", "ention", "schen"])
    return table(spark, sf, "conversations").select("conv_id", "turn", title.alias("title"))


@query("""
SELECT p_partkey, array_to_string(list_filter(list_transform(
    string_split_regex('ㆍ' || p_type || ' · ' || p_brand || '•·' || p_name || '·', '[ㆍ·•]'), lambda x: trim(x)),
    lambda x: x <> ''), ', ') AS duties
FROM part""")
def bullet_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(
        F.lit("ㆍ"), "p_type", F.lit(" · "), "p_brand", F.lit("•·"), "p_name", F.lit("·")
    )
    return table(spark, sf, "part").select("p_partkey", text.bullets_to_commas(raw).alias("duties"))


@query("""
SELECT c_custkey,
  CASE WHEN c_nationkey < 20 THEN 'U' || c_custkey || CASE WHEN c_nationkey < 5 THEN '대' ELSE '대학교' END ELSE '' END AS school,
  CASE WHEN c_nationkey < 15 THEN c_mktsegment || '학과' ELSE '' END AS department,
  CASE WHEN c_nationkey < 10 THEN '부교수' WHEN c_nationkey < 20 THEN '교수' ELSE '' END AS title
FROM customer""")
def affiliation_extract(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("c_nationkey")
    school = F.concat(F.lit("U"), F.col("c_custkey"), F.when(n < 5, "대").otherwise("대학교"))
    department = F.when(n < 15, F.concat(F.lit(" "), "c_mktsegment", F.lit("학과"))).otherwise("")
    title = F.when(n < 10, " 부교수").when(n < 20, " 교수").otherwise(" 연구원")
    phrase = F.concat(F.lit("(현) "), school, department, title, F.lit(" 겸 자문"))
    return table(spark, sf, "customer").select("c_custkey", affiliation(phrase).alias("a")).select("c_custkey", "a.*")


HEADERS = [
    "성 명", "이름", "Name", "성별", "출생\n년월", "직 위", "직책", "Position", "등기임원 여부", "상근여부",
    "담당업무", "담당", "주요 경력", "소유주식수(의결권 있는 주식)", "소유주식수(의결권 없는 주식)", "의결권O 소유주식",
    "최대주주와의 관계", "재직기간", "임기 만료일", "만료일", "비고", "소유주식수", "\"성명\"", "번호", "의결권X 주식",
]


@query("""
SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'name' WHEN 1 THEN 'name' WHEN 2 THEN 'name' WHEN 3 THEN 'gender'
  WHEN 4 THEN 'birth_ym' WHEN 5 THEN 'position' WHEN 6 THEN 'position' WHEN 7 THEN 'position'
  WHEN 8 THEN 'registered' WHEN 9 THEN 'full_time' WHEN 10 THEN 'duty' WHEN 11 THEN 'duty' WHEN 12 THEN 'career'
  WHEN 13 THEN 'shares_voting' WHEN 14 THEN 'shares_nonvoting' WHEN 15 THEN 'shares_voting'
  WHEN 16 THEN 'holder_relation' WHEN 17 THEN 'tenure' WHEN 18 THEN 'term_end' WHEN 19 THEN 'term_end'
  WHEN 22 THEN 'name' WHEN 24 THEN 'shares_nonvoting' END AS field
FROM customer""")
def header_map(spark: SparkSession, sf: str) -> DataFrame:
    header = F.get(F.array(*[F.lit(h) for h in HEADERS]), F.col("c_nationkey"))
    return table(spark, sf, "customer").select("c_custkey", header_field(header).alias("field"))


@query("""
SELECT c_custkey AS corp_code_number, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS corp_code, c_name AS corp_name,
  CASE WHEN c_nationkey = 7 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS stock_code, c_mktsegment AS note
FROM customer""")
def header_canonical(spark: SparkSession, sf: str) -> DataFrame:
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    odd = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("number"),
        F.lit("english").alias("corp_eng_name"),
        F.concat(F.lit(" "), code, F.lit(".0 ")).alias(" 회사코드 "),
        F.concat(F.col("c_name"), F.lit("　")).alias("Corp_Name"),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey")).alias("종목코드(6자리)"),
        F.col("c_mktsegment").alias(" note"),
    )
    return canonical_roster(odd).select(
        F.col("number").alias("corp_code_number"), "corp_code", "corp_name", "stock_code", "note"
    )


@query("""
SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, '' AS note FROM customer
UNION ALL SELECT s_name, CAST(s_nationkey AS BIGINT), '', '' FROM supplier""")
def union_missing(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("long").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    right = table(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("long").alias("nation"), F.col("s_name").alias("name")
    )
    return with_columns_present(union_by_name(left, right), ["name", "nation", "segment", "note"]).fillna("")


@query("""
SELECT d.doc_id, k.kw_idx, k.keyword, k.base_score FROM documents d JOIN (VALUES
  (0, 'ention', 100), (1, 'ation', 90), (2, 'que', 85), (3, 'der', 70), (4, 'heit', 60), (5, 'les', -10),
  (6, 'sch', -10), (7, 'vi', -10)) AS k(kw_idx, keyword, base_score) ON contains(d.text, k.keyword)""")
def keyword_hits(spark: SparkSession, sf: str) -> DataFrame:
    words = [("ention", 100), ("ation", 90), ("que", 85), ("der", 70), ("heit", 60), ("les", -10), ("sch", -10), ("vi", -10)]
    hits = hits_of(table(spark, sf, "documents").select("doc_id", "text"), F.col("text"), words)
    return hits.drop("text")
