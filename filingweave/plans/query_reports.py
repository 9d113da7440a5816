"""Queries on selection, joins and grouped picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.functions.codes import company_code
from filingweave.operators import grouped, merge, pending, reports
from filingweave.operators.best_match import best_after
from filingweave.operators.ordered import count_later_pairs
from filingweave.plans.registry import query, table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
VIEWER = "https://example.org/view"


def report_like(orders: DataFrame) -> DataFrame:
    """Orders in the shape of selectable reports."""
    return orders.select(
        company_code(F.col("o_custkey")).alias("company_id"),
        F.lpad(F.col("o_orderkey").cast("string"), 14, "0").alias("rcept_no"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"),
        F.col("o_orderpriority").alias("report_type"),
    )


@query("""
SELECT company_id, rcept_no, rcept_dt, report_type, 'https://example.org/view?rcpNo=' || rcept_no AS url FROM (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS company_id, lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS rcept_no,
    strftime(o_orderdate, '%Y%m%d') AS rcept_dt, o_orderpriority AS report_type,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) WHERE rn = 1""")
def latest_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    latest = reports.latest_by_priority(
        report_like(table(spark, sf, "orders")), ["company_id"], "report_type", PRIORITIES, ["rcept_dt", "rcept_no"]
    )
    return latest.withColumn("url", reports.viewer_url(VIEWER, F.col("rcept_no")))


@query("""
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders
WHERE o_orderdate >= DATE '1998-08-02' - 730 AND o_orderdate < DATE '1998-08-03'""")
def window_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    inside = orders.where(reports.in_window(F.col("o_orderdate"), F.lit("1998-08-02").cast("date"), 2, fmt=None))
    return inside.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day"))


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19960802' AND '19980802'""")
def window_filter_text(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    inside = reports.in_window(day, F.lit("1998-08-02").cast("date"), 2)
    return table(spark, sf, "orders").where(inside).select("o_orderkey", "o_custkey")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 5""")
def cap_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    top = grouped.top_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5)
    return top.drop("o_orderdate")


@query("""
WITH info AS (
  SELECT o_custkey, arg_min(o_orderdate, o_orderkey) AS d, arg_min('https://example.org/view?rcpNo=' || o_orderkey, o_orderkey) AS url
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_name AS company, lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS stock_code,
  coalesce(CAST(year(d) AS VARCHAR), '정보없음') AS report_type, coalesce(url, '') AS url
FROM customer LEFT JOIN info ON c_custkey = o_custkey""")
def summary_left_join(spark: SparkSession, sf: str) -> DataFrame:
    roster = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("corp_code"),
        F.col("c_name").alias("corp_name"),
        F.col("c_nationkey").cast("string").alias("stock_code"),
    )
    orders = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    info = orders.select(
        company_code(F.col("o_custkey")).alias("company_id"),
        F.col("o_orderkey").alias("row_index"),
        F.year("o_orderdate").cast("string").alias("report_type"),
        reports.viewer_url(VIEWER, F.col("o_orderkey").cast("string")).alias("url"),
    )
    return merge.company_summary(roster, info)


@query("""
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS company_id, c_name AS company,
  coalesce(report_type, '정보없음') AS report_type, coalesce(rcept_no, '') AS rcept_no
FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderpriority AS report_type, lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS rcept_no,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus = 'F')
ON c_custkey = o_custkey AND rn = 1""")
def selected_reports(spark: SparkSession, sf: str) -> DataFrame:
    finished = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    latest = reports.latest_by_priority(
        report_like(finished), ["company_id"], "report_type", PRIORITIES, ["rcept_dt", "rcept_no"]
    )
    roster = table(spark, sf, "customer").select(
        company_code(F.col("c_custkey")).alias("company_id"), F.col("c_name").alias("company")
    )
    return merge.left_join_filled(
        roster, latest, ["company_id"], {"report_type": "정보없음", "rcept_no": ""}
    )


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_linenumber > 2 THEN l_returnflag END AS flag, CASE WHEN l_quantity > 25 THEN l_linestatus END AS status,
    CASE WHEN l_discount > 0.03 THEN l_partkey END AS part FROM lineitem)
SELECT l_orderkey, arg_min(flag, (l_linenumber, l_partkey, l_suppkey)) FILTER (flag IS NOT NULL) AS flag,
  arg_min(status, (l_linenumber, l_partkey, l_suppkey)) FILTER (status IS NOT NULL) AS status,
  arg_min(part, (l_linenumber, l_partkey, l_suppkey)) FILTER (part IS NOT NULL) AS part
FROM x WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey""")
def first_non_null(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") > 2, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_quantity") > 25, F.col("l_linestatus")).alias("status"),
        F.when(F.col("l_discount") > 0.03, F.col("l_partkey")).alias("part"),
    )
    return grouped.first_non_null(
        lines, ["l_orderkey"], ["flag", "status", "part"], ["l_linenumber", "l_partkey", "l_suppkey"]
    )


@query("""
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END
  ORDER BY o_orderdate, o_orderkey) AS rn FROM (SELECT * REPLACE (
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority) FROM orders)) WHERE rn = 1""")
def distinct_on(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderkey", "o_totalprice", "o_orderdate",
    )
    return grouped.distinct_on(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""
SELECT c_name AS company, stock_code, name, duty, '' AS career, '' AS school, '' AS department, '' AS prof_title FROM (
  SELECT c_name, lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS stock_code, o_orderpriority AS name,
    CAST(o_orderkey AS VARCHAR) AS duty, row_number() OVER (PARTITION BY c_name, o_orderpriority, o_orderstatus
      ORDER BY lpad(CAST(o_custkey AS VARCHAR), 8, '0'), lpad(CAST(o_orderkey AS VARCHAR), 14, '0')) AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '4-NOT SPECIFIED') WHERE rn = 1""")
def executives(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    name = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "  ").otherwise(F.col("o_orderpriority"))
    mapped = (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_name").alias("company"),
            F.lpad(F.col("c_nationkey").cast("string"), 6, "0").alias("stock_code"),
            name.alias("name"),
            F.col("o_orderstatus").alias("position"),
            F.col("o_orderkey").cast("string").alias("duty"),
            company_code(F.col("o_custkey")).alias("company_id"),
            F.lpad(F.col("o_orderkey").cast("string"), 14, "0").alias("rcept_no"),
            F.lit(0).alias("source_xml_index"),
            F.lit(0).alias("row_index"),
        )
    )
    return merge.executive_sheet(mapped)


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def pending_one_key(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return pending.pending(customers, done.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b
  WHERE b.l_returnflag = 'R' AND b.l_orderkey = a.l_orderkey AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)""")
def pending_three_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    return pending.pending(lines.select(*keys, "l_quantity"), lines.where("l_returnflag = 'R'"), keys)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS first FROM lineitem WHERE l_quantity > 20)
WHERE l_linenumber = first""")
def first_document(spark: SparkSession, sf: str) -> DataFrame:
    large = table(spark, sf, "lineitem").where("l_quantity > 20").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return grouped.rows_of_first(large, ["l_orderkey"], "l_linenumber")


@query("""
SELECT user_id, count(*) FILTER (e.ts < p.ts) AS n_pairs FROM
  (SELECT user_id, ts FROM events WHERE event_type = 'error') e
  JOIN (SELECT user_id, ts FROM events WHERE event_type = 'purchase') p USING (user_id)
GROUP BY user_id""")
def later_pairs(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    pairs = count_later_pairs(
        table(spark, sf, "events"), ["user_id"], "ts", kind == "error", kind == "purchase",
        chunk=F.unix_date(F.to_date("ts")),
    )
    return pairs


LEVELS = [(100, 0), (90, 1), (50, 0), (-10, 2)]


@query("""
WITH hits AS (
  SELECT user_id, event_id AS pos, CASE WHEN event_type = 'signup' AND value < 50 THEN 100 WHEN event_type = 'signup' THEN 50
      WHEN event_type = 'click' THEN 90 ELSE -10 END AS score,
    CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS rank
  FROM events WHERE event_type IN ('signup', 'click', 'view')),
targets AS (
  SELECT user_id, event_id AS pos, CASE WHEN value > 60 THEN 35 WHEN value > 20 THEN 20 ELSE 15 END AS bonus
  FROM events WHERE event_type IN ('purchase', 'error') AND value > 10),
scored AS (SELECT t.user_id, h.score + t.bonus AS score, h.rank, h.pos AS hit_pos, t.pos AS target_pos,
    row_number() OVER (PARTITION BY t.user_id ORDER BY h.score + t.bonus DESC, h.rank, h.pos, t.pos) AS rn
  FROM targets t JOIN hits h ON h.user_id = t.user_id AND h.pos < t.pos WHERE h.score + t.bonus >= 0)
SELECT user_id, score, rank, hit_pos, target_pos FROM scored WHERE rn = 1""")
def running_best(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", F.col("event_id").alias("pos"), "event_type", "value")
    kind, value = F.col("event_type"), F.col("value")
    level = (
        F.when((kind == "signup") & (value < 50), 0).when(kind == "click", 1)
        .when(kind == "signup", 2).when(kind == "view", 3)
    )
    hits = events.select("user_id", "pos", level.alias("level")).where(F.col("level").isNotNull())
    bonus = F.when(value > 60, 35).when(value > 20, 20).otherwise(15)
    targets = events.where(kind.isin("purchase", "error") & (value > 10)).select("user_id", "pos", bonus.alias("bonus"))
    return best_after(hits, targets, ["user_id"], LEVELS)
