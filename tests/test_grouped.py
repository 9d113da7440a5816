"""Picks, joins, windows over groups, and their behaviour on hot keys."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from filingweave.operators import best_match, grouped, merge, ordered, pending, reports


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_report_priority_and_ties(spark):
    items = spark.createDataFrame(
        [
            ("a", 0, "사업보고서", "9", "20240301"),
            ("a", 1, "분기보고서", "1", "20230301"),
            ("a", 2, "분기보고서", "2", "20230301"),
            ("b", 0, "반기보고서", None, None),
            ("b", 1, "사업보고서", "5", "20240101"),
            ("c", 0, "감사보고서", "7", "20240101"),
            ("d", 5, "분기보고서", "3", "20230101"),
            ("d", 4, "[기재정정]분기보고서", "3", "20230101"),
            ("e", 0, None, "1", "20240101"),
        ],
        "company_id string, listing_pos long, report_nm string, rcept_no string, rcept_dt string",
    )
    got = reports.select_reports(items, listing_order=["listing_pos"])
    assert rows(got.select("company_id", "report_type", "rcept_no", "reprt_code", "listing_pos")) == [
        ("a", "분기", "2", "11013", 2), ("b", "반기", None, "11012", 0), ("d", "분기", "3", "11013", 4),
    ]


def test_first_non_null_and_distinct_on(spark):
    df = spark.createDataFrame(
        [("a", 2, "x", None), ("a", 1, None, None), ("a", 3, "y", "u"), (None, 1, "z", "z"), ("b", 1, None, None)],
        "k string, o int, p string, q string",
    )
    assert rows(grouped.first_non_null(df, ["k"], ["p", "q"], ["o"]).fillna("-")) == [("a", "x", "u"), ("b", "-", "-")]
    twice = spark.createDataFrame([("a", None, 2), ("a", None, 1), ("a", " ", 3)], "k string, p string, o int")
    assert sorted(grouped.distinct_on(twice, ["k", "p"], ["o"]).collect(), key=str) == sorted(
        twice.where("o in (1, 3)").collect(), key=str
    )


def test_top_per_key_against_sorting(spark):
    random.seed(3)
    data = [(random.choice("aaaab"), i, random.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    got = rows(grouped.top_per_key(df, ["k"], [F.desc("v"), "i"], 7))
    want = []
    for key in "ab":
        want += sorted((r for r in data if r[0] == key), key=lambda r: (-r[2], r[1]))[:7]
    assert got == sorted(want)


def test_pending_with_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, i int")
    done = spark.createDataFrame([("a", 1), ("a", 1), ("z", 9)], "k string, i int")
    assert sorted(r.i for r in pending.pending(df, done, ["k", "i"]).collect()) == [2, 3]
    assert sorted(r.i for r in pending.pending(df, done, ["k"]).collect()) == [3]


def test_company_summary(spark):
    roster = spark.createDataFrame(
        [("126380", "A", "5930"), ("A126380", "A2", None), ("2", "B", "36720.0"), ("123456789", "C", "1234567"), ("126380", "A", "5930")],
        "corp_code string, corp_name string, stock_code string",
    )
    info = spark.createDataFrame(
        [("00126380", "2", 0, 1, "반기", "u2"), ("00126380", "1", 0, 0, None, "u1"), (None, "1", 0, 0, "분기", "u")],
        "company_id string, rcept_no string, source_xml_index int, row_index int, report_type string, url string",
    )
    assert rows(merge.company_summary(roster, info, mark_bad_codes=True)) == [
        ("A", "005930", "반기", "u1"), ("A", "005930", "반기", "u1"), ("A2", "", "반기", "u1"),
        ("B", "036720", "정보없음", ""), ("C", "1234567", "코드오류", ""),
    ]


def test_executive_sheet(spark):
    data = [
        ("A", "1", "Kim", "CEO", "d1", 1), ("A", "1", "Kim", "CEO", "d0", 0), ("A", "1", "Kim", None, "d2", 2),
        ("A", "1", "Kim", None, "d3", 3), ("A", "1", "  ", "CEO", "d4", 4), ("A", "1", None, "CEO", "d5", 5),
    ]
    df = spark.createDataFrame(data, "company string, stock_code string, name string, position string, duty string, row_index int")
    full = df.withColumns({"company_id": F.lit("c"), "rcept_no": F.lit("r"), "source_xml_index": F.lit(0)})
    sheet = merge.executive_sheet(full)
    assert sorted(r.duty for r in sheet.collect()) == ["d0", "d2"]
    assert sheet.columns == ["company", "stock_code", "name", "duty", "career", "school", "department", "prof_title"]
    assert merge.executive_sheet(full, dedupe=False).count() == 4


def test_numbered_equals_row_number(spark):
    random.seed(4)
    data = [(random.choice(["a", "a", "a", None]), random.randint(0, 9), i) for i in range(400)]
    df = spark.createDataFrame(data, "k string, o int, i int")
    want = []
    for key in ("a", None):
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        want += [(*r, n) for n, r in enumerate(group)]
    for chunk in (None, F.floor(F.col("o") / 3), F.lit(0)):
        got = ordered.numbered(df, ["k"], ["o", "i"], chunk).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("ties", [False, True])
def test_a_chunk_that_holds_all_rows_is_split(spark, ties):
    rows = spark.range(20_000).selectExpr("if(id < 19000, 'hot', 'cold') as k", f"{'0L' if ties else '(id * 7919) % 20011'} as o", "id as i")
    day = F.when(F.col("i") == 0, None).otherwise(F.lit(3))
    chunked = ordered.with_chunks(rows, ["k"], ["o"], day, chunk_rows=1000)
    sizes = chunked.groupBy("k", "_chunk").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] < 2000 and sizes[1] > 20
    got = ordered.numbered(rows, ["k"], ["o"], day, chunk_rows=1000).collect()
    assert len(got) == 20_000
    for key in ("hot", "cold"):
        group = sorted((r.row_no, r.o) for r in got if r.k == key)
        assert [n for n, _ in group] == list(range(len(group)))
        if not ties:
            own = [o for _, o in group]
            assert own[1:] == sorted(own[1:]) if key == "hot" else own == sorted(own)


def test_later_pairs_in_one_crowded_chunk(spark):
    random.seed(8)
    data = [(random.randint(0, 1), random.randint(0, 40), random.choice("lr")) for _ in range(600)]
    df = spark.createDataFrame(data, "k int, p int, kind string")
    want = defaultdict(int)
    for k, p, kind in data:
        want[k] += sum(kind == "l" and k == k2 and p < p2 and kind2 == "r" for k2, p2, kind2 in data)
    got = ordered.count_later_pairs(df, ["k"], "p", F.col("kind") == "l", F.col("kind") == "r", F.lit(0), chunk_rows=50)
    assert dict(got.collect()) == dict(want)


def test_later_pairs_against_brute_force(spark):
    random.seed(5)
    data = [(random.randint(0, 2), random.randint(0, 60), random.choice("lrx")) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, p int, kind string")
    want = defaultdict(int)
    for k, p, kind in data:
        want[k] += sum(kind == "l" and k == k2 and p < p2 and kind2 == "r" for k2, p2, kind2 in data)
    got = ordered.count_later_pairs(
        df, ["k"], "p", F.col("kind") == "l", F.col("kind") == "r", F.floor(F.col("p") / 7)
    )
    assert dict(got.collect()) == dict(want)


def test_best_after_against_brute_force(spark):
    random.seed(6)
    levels = [(100, 0), (50, 0), (90, 1), (40, 1), (-10, 2), (-60, 2)]
    hits = [(random.randint(0, 15), p, random.randrange(6)) for p in range(0, 300, 2)]
    targets = [(random.randint(0, 15), p, random.choice([15, 20, 35])) for p in range(1, 300, 2)]
    want = {}
    for k, tp, bonus in targets:
        for hk, hp, level in hits:
            score = levels[level][0] + bonus
            if hk == k and hp < tp and score >= 0:
                rank = (-score, levels[level][1], hp, tp)
                want[k] = min(want.get(k, rank), rank)
    got = best_match.best_after(
        spark.createDataFrame(hits, "k int, pos int, level int"),
        spark.createDataFrame(targets, "k int, pos int, bonus int"), ["k"], levels,
    )
    assert {r.k: (-r.score, r["rank"], r.hit_pos, r.target_pos) for r in got.collect()} == want


@pytest.fixture
def small_skew_limits(spark):
    """Join limits scaled down to test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("operator", ["best_after", "pending", "left_join", "rows_of_first"])
def test_hot_join_key_is_split_at_run_time(spark, small_skew_limits, operator):
    """A key with a third of all rows is read by several tasks, also where an aggregate meets the join."""
    big = spark.range(0, 300_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 7, id % 997) as k", "id as pos", "cast(id % 3 * 5 + 15 as int) as bonus", "uuid() as pad"
    )
    small = spark.range(0, 3000, 1, 4).selectExpr(
        "id % 900 + 50 as k", "id as pos", "cast(id % 2 as int) as level", "cast(id as string) as v"
    )
    joined = {
        "best_after": lambda: best_match.best_after(small, big, ["k"], [(10, 0), (5, 1)]),
        "pending": lambda: pending.pending(big, small, ["k"]),
        "left_join": lambda: merge.left_join_filled(
            big, grouped.first_non_null(small, ["k"], ["v"], ["pos"]), ["k"], {"v": ""}
        ),
        "rows_of_first": lambda: grouped.rows_of_first(big, ["k"], "bonus"),
    }[operator]()
    assert "skew=true" in executed_plan(joined)


@pytest.mark.parametrize("operator", ["latest", "distinct", "first", "value_counts"])
def test_hot_key_is_combined_before_the_shuffle(spark, operator):
    """All rows in one key: each map task hands on one row for it."""
    df = spark.range(0, 80_000, 1, 8).selectExpr("'hot' as k", "cast(id as string) as v", "'분기' as t", "id")
    made = {
        "latest": lambda: reports.latest_by_priority(df, ["k"], "t", ["분기"], ["id"]),
        "distinct": lambda: grouped.distinct_on(df, ["k"], ["id"]),
        "first": lambda: grouped.first_non_null(df, ["k"], ["v"], ["id"]),
        "value_counts": lambda: grouped.value_counts(df, "k"),
    }[operator]()
    made.collect()
    plan = made._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "partial_" in text and "Exchange hashpartitioning" in text
    shuffled = []

    def walk(node):
        if node.nodeName() in ("Exchange", "ShuffleQueryStage", "AQEShuffleRead"):
            metric = node.metrics().get("shuffleRecordsWritten")
            if metric.isDefined():
                shuffled.append(metric.get().value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    assert shuffled and max(shuffled) <= 8
