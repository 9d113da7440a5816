"""Documents, tables, archives."""

import gc
import io
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filingweave import fixed_values as fv
from filingweave.operators import markup
from filingweave.operators.nodes import _Reader, _tables, any_of, read_nodes
from filingweave.plans.query_stages import stored_zip
from filingweave.sources import archives as sources
from filingweave.sources.archives import _entries, _plain_entry, _unpacked, decode, read_archives, readable, unpack, unreadable

FULL = "<tr><td>성명</td><td>성별</td><td>출생년월</td><td>직위</td><td>등기임원</td><td>상근</td></tr>"
BONUS_ONLY = "<tr><td>성명</td><td>직위</td><td>임기</td></tr>"
WORDS = [w for w, _ in fv.KEYWORD_SCORES]


def table(*cells, header=FULL):
    return f"<table>{header}<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr></table>"


def extract(spark, text, **options):
    """Cells of the document's data rows."""
    df = spark.createDataFrame([("r", 0, text)], "rcept_no string, xml_index int, xml_text string")
    rows = markup.extract_rows(df, **options).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(len(rows)))
    return [r.cells for r in rows]


CASES = {
    "padded_and_stripped": (
        "<P>가. 임원의 현황</P><TABLE><TBODY>" + FULL + "<TR><TD>홍<br>길동</TD><td> 이사&nbsp;</td></TR></TBODY></TABLE>",
        [["홍길동", "이사", "", "", "", ""]],
    ),
    "decoy_before_keyword": (table("decoy") + "<p>가. 등기임원</p>" + table("real"), [["real", *[""] * 5]]),
    "table_around_keyword_is_not_after_it": (
        "<table><tr><td>가. 임원의 현황</td></tr>" + FULL + "</table>" + table("real"), [["real", *[""] * 5]],
    ),
    "first_table_wins_a_tie": ("<p>등기임원</p>" + table("one") + "<p>등기임원</p>" + table("two"), [["one", *[""] * 5]]),
    "better_keyword_later": ("<p>임원 현황</p>" + table("one") + "<p>가. 등기임원</p>" + table("two"), [["two", *[""] * 5]]),
    "concurrent_alone": ("<p>나. 등기임원의 타회사 겸직 현황</p>" + table("c"), [["c", *[""] * 5]]),
    "concurrent_before_real": (
        "<p>나. 등기임원의 타회사 겸직 현황</p>" + table("c") + "<div><p>x</p><p>y</p><p>가. 등기임원</p></div>" + table("real"),
        [["real", *[""] * 5]],
    ),
    "concurrent_in_previous_sibling": ("<p>겸직</p><p>나. 임원</p>" + table("c", header=BONUS_ONLY), []),
    "two_siblings_back_only": ("<p>겸직</p><p>1</p><p>2</p><p>나. 임원</p>" + table("c", header=BONUS_ONLY), [["c", "", ""]]),
    "blank_text_is_a_sibling": ("<p>겸직</p>\n<p>1</p><p>나. 임원</p>" + table("c", header=BONUS_ONLY), [["c", "", ""]]),
    "negative_score": ("<p>나. 임원 겸직</p>" + table("c"), []),
    "few_tokens": ("<p>가. 등기임원</p><table><tr><td>성명</td><td>x</td></tr></table>", []),
    "bonus_suffices": ("<p>가. 등기임원</p>" + table("a", header=BONUS_ONLY), [["a", "", ""]]),
    "thead_without_tbody": (
        "<p>가. 등기임원</p><table><thead>" + FULL + "</thead>" + FULL + "<tr><td>a</td></tr></table>", [["a", *[""] * 5]],
    ),
    "first_tbody_only": (
        "<p>가. 등기임원</p><table><tbody>" + FULL + "<tr><td>a</td></tr></tbody><tbody><tr><td>b</td></tr></tbody></table>",
        [["a", *[""] * 5]],
    ),
    "th_rows_dropped": (
        "<p>가. 등기임원</p><table><tr><th>성명</th><th>직위</th><th>임기</th></tr><tr><th>계</th></tr><tr><td>a</td></tr></table>", [["a"]],
    ),
    "blank_rows_dropped": (
        "<p>가. 등기임원</p><table>" + FULL + "<tr><td> </td><td>&#12288;</td></tr><tr></tr><tr><td>a</td></tr></table>",
        [["a", *[""] * 5]],
    ),
    "other_cells_lose_blanks": (
        "<p>가. 등기임원</p><table>" + FULL + "<tr><tu>a</tu><tu> </tu><te>b</te></tr></table>", [["a", "b", *[""] * 4]],
    ),
    "td_beats_other_cells": (
        "<p>가. 등기임원</p><table>" + FULL + "<tr><tu>x</tu><td>a</td><th>y</th></tr></table>", [["a", *[""] * 5]],
    ),
    "nested_table_is_its_own": (
        "<p>가. 등기임원</p><table>" + FULL + "<tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>",
        [["ain", "b", *[""] * 4]],
    ),
    "split_keyword": ("<p>가. 등기<b>임원</b></p>" + table("a"), []),
    "nbsp_keyword": ("<p>가.&nbsp;임원의&nbsp;현황</p>" + table("a"), []),
    "entity_keyword": ("<p>&#44032;. &#46321;&#44592;&#51076;&#50896;</p>" + table("a"), [["a", *[""] * 5]]),
    "comment_keyword": ("<!-- 등기임원 -->" + table("a"), [["a", *[""] * 5]]),
    "no_table": ("<p>가. 등기임원</p>", []),
    "empty": ("", []),
}


@pytest.fixture(scope="module")
def extracted(spark):
    """All cases as documents of one DataFrame."""
    docs = [(name, text) for name, (text, _) in CASES.items()]
    rows = markup.extract_rows(spark.createDataFrame(docs, "name string, xml_text string")).collect()
    found = {name: [] for name in CASES}
    for r in sorted(rows, key=lambda r: r.row_index):
        assert r.row_index == len(found[r.name])
        found[r.name].append(r.cells)
    return found


@pytest.mark.parametrize("name", CASES)
def test_extraction_cases(extracted, name):
    got, want = extracted[name], CASES[name][1]
    if want and got and got[0][0] == "성명":
        got = got[1:]  # a td row that looks like a header stays as data
    assert got == want


def test_first_td_row_stays(spark):
    assert extract(spark, "<p>가. 등기임원</p>" + table("a"))[0] == ["성명", "성별", "출생년월", "직위", "등기임원", "상근"]


def test_options(spark):
    other = "<p>가. 등기임원</p><table>" + FULL + "<tr><tu>a</tu><tu> </tu><te>b</te></tr></table>"
    assert extract(spark, other, keep_empty_cells=True)[1][:3] == ["a", "", "b"]
    assert extract(spark, CASES["nbsp_keyword"][0], squash_headings=True)[1][0] == "a"
    assert extract(spark, CASES["split_keyword"][0], squash_headings=True) == []


def test_first_document_option_and_header(spark):
    docs = [("r", 2, "<p>등기임원</p>" + table("late")), ("r", 1, "<p>등기임원</p>" + table("soon")), ("r", 0, "<p>등기임원</p>"), ("s", 0, None)]
    df = spark.createDataFrame(docs, "rcept_no string, xml_index int, xml_text string")
    assert markup.extract_rows(df).select("rcept_no", "xml_index").distinct().count() == 2
    first = markup.extract_rows(df, first_of=["rcept_no"]).collect()
    assert {(r.xml_index, r.cells[0]) for r in first} == {(1, "성명"), (1, "soon")}
    assert {tuple(r.header) for r in first} == {("성명", "성별", "출생년월", "직위", "등기임원", "상근")}


def brute_force_best(nodes):
    """All pairs, then one stable sort: the definition, not the method."""
    texts, tables = nodes
    pairs = []
    for i, (word, base) in enumerate(fv.KEYWORD_SCORES):
        for hit, text, marked in texts:
            if word not in text:
                continue
            for pos, content, *_ in tables:
                if pos <= hit:
                    continue
                norm = "".join(content.replace('"', "").replace("'", "").split())
                tokens = sum(w in norm for w in fv.HEADER_TOKENS)
                bonus = all(w in norm for w in fv.BONUS_WORDS)
                concurrent = marked or fv.CONCURRENT_WORD in text
                score = base + 20 * (tokens >= 6) + 15 * bonus - 50 * concurrent
                if score >= 0 and (tokens >= 6 or bonus):
                    pairs.append((score, i, pos))
    pairs.sort(key=lambda p: -p[0])
    return pairs[0] if pairs else None


def test_best_table_against_brute_force(spark):
    random.seed(7)
    pieces = [f"<p>{w}</p>" for w in WORDS] + ["<p>겸직</p>", "<div>", "</div>", "text", *[table(i) for i in range(3)],
              *[table(i, header=BONUS_ONLY) for i in range(3)], "<table><tr><td>x</td></tr></table>",
              table("임기만료일 재직기간", header=FULL + BONUS_ONLY)]
    docs = ["".join(random.choice(pieces) for _ in range(random.randint(1, 14))) for _ in range(400)]
    want = [brute_force_best(read_nodes(d, any_of(WORDS), fv.CONCURRENT_WORD)) for d in docs]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, t string")
    best = df.select("i", markup.markup_nodes(F.col("t")).alias("n")).select("i", markup.best_table(F.col("n")).alias("b"))
    got = [r.b and (r.b.score, -r.b["rank"], -r.b.pos) for r in best.orderBy("i").collect()]
    assert got == want
    assert sum(w is not None for w in want) > 200


def test_many_tables_in_one_document(spark):
    text = "<p>등기임원</p>" + "".join(table(i) for i in range(2000)) + "<p>가. 임원의 현황</p>" + table("last")
    assert extract(spark, text)[1][0] == "last"


PIECES = [
    "<p>", "</p>", "<table>", "</table>", "<tr>", "<td>", "</td>", "</tr>", "<TD a='1' b=\"x>y\" c=3>", "<br/>", "<br>", "<b/>",
    "가. 등기임원", "겸직", " ", "\n", "a &amp; b", "&lt;&#44032;&nbsp;", "&nosuch;", "&am", "<!-- c -->", "<!---->", "<!-- a-b -->",
    "<!--x--y-->", "<?xml version='1.0'?>", "<!DOCTYPE html>", "<title>t</title>", "<title>a<b></title>", "<script>x<1</script>",
    "<", "< a", "<a href=x/>", "<a b=\"c\"d>", "</ p>", "</p >", "<![CDATA[z]]>", "<a b>", "<x:y z:w='1'>", "</x:y>", "<tbody>",
    "</tbody>", "<thead>", "</thead>", "\r\n", "<p\n>", "</>", "<1>", "<a =b>", "&", "\x00", "<a b='>",
]


def test_fast_reader_equals_lenient_reader():
    random.seed(8)
    same = 0
    for _ in range(6000):
        text = "".join(random.choice(PIECES) for _ in range(random.randint(1, 12)))
        fast, lenient = _Reader(any_of(WORDS)), _Reader(any_of(WORDS))
        if fast.read_well_formed(text):
            lenient.read(text)
            assert [h[:2] for h in fast.hits] == [h[:2] for h in lenient.hits], text
            assert [(t.name, t.pos) for t in fast.tags] == [(t.name, t.pos) for t in lenient.tags], text
            assert _tables(fast.tags) == _tables(lenient.tags), text
            same += 1
    assert same > 500


def zipped(entries):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for name, data in entries:
            z.writestr(name, data)
    return body.getvalue()


def test_decoding_cascade():
    assert decode("임원".encode("euc-kr")) == "임원"
    assert decode("€임원".encode()) == "€임원"
    assert decode(b"\xff\xfeab") == "ab"


def test_archive_scan(spark, tmp_path):
    broken = bytearray(zipped([("a.xml", b"x" * 100), ("b.xml", b"fine")]))
    broken[45] ^= 0xFF
    files = {
        "sub/20240001.zip": zipped([("b.xml", "둘".encode("euc-kr")), ("a.xml", "€하나".encode())]),
        "20240002.zip": bytes(broken),
        "20240003.zip": b"PK no archive",
        "20240004.xml": "<p>등기임원</p>".encode("euc-kr"),
        "20240005.xml": b"<?xml version='1.0'?><result><status>013</status><message>none</message></result>",
        "20240006.xml": b"<result><message>ok</message><status>000</status></result>",
        "20240007.zip": zipped([]),
    }
    for name, data in files.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(data)
    archives = read_archives(spark, str(tmp_path))
    staged = unpack(archives)
    texts = {(r.rcept_no, r.xml_index): r.xml_text for r in readable(staged).collect()}
    assert texts == {("20240001", 0): "€하나", ("20240001", 1): "둘", ("20240002", 1): "fine"}
    errors = {(r.rcept_no, r.xml_index): r.error for r in unreadable(staged).collect()}
    assert errors.keys() == {("20240002", 0), ("20240003", None), ("20240004", None), ("20240005", None), ("20240006", None)}
    single = unpack(archives, plain_documents=True)
    plain = {r.rcept_no: r.xml_text for r in readable(single).collect() if r.rcept_no > "20240003"}
    assert plain.keys() == {"20240004", "20240006"} and plain["20240004"] == "<p>등기임원</p>"
    assert "status 013" in {r.error for r in unreadable(single).collect()}


def test_tables_before_the_first_heading_stay_in_the_worker():
    before = "<table><tr><td>a</td></tr></table>"
    behind = "<table><tr><td>b<table><tbody></tbody><tr><td>c</td></tr></table></td></tr></table>"
    _, tables = read_nodes(f"{before}<p>임원</p>{behind}", any_of(["임원"]), "겸직", behind_hits=True)
    assert [(text, len(rows), body) for _, text, rows, body in tables] == [("bc", 1, False), ("c", 1, True)]
    assert read_nodes(before, any_of(["임원"]), "겸직", behind_hits=True)[1] == []


def test_an_empty_first_body_has_no_rows(spark):
    full = "".join(f"<th>{h}</th>" for h in ("성명", "성별", "직위", "담당업무", "주요경력", "임기"))
    head = f"<p>가. 임원의 현황</p><table><thead><tr>{full}</tr></thead>"
    row = "<tr><td>홍길동</td></tr>"
    docs = [(1, f"{head}<tbody></tbody><tbody>{row}</tbody></table>"), (2, f"{head}{row}</table>"), (3, f"{head}<tbody>{row}</tbody></table>")]
    found = markup.extract_rows(spark.createDataFrame(docs, "xml_index int, xml_text string"))
    assert sorted(r.xml_index for r in found.collect()) == [2, 3]


def test_squashed_headings_with_entities_are_read(spark):
    names = "<table><tr><td>성명</td><td>직위</td><td>임기</td><td>담당업무</td><td>주요경력</td><td>성별</td></tr><tr><td>홍</td></tr></table>"
    heads = ["가.&nbsp;임원의&nbsp;현황", "가. 임원의 현황", "가. &quot;임원의&quot; 현황", "다른 제목 &nbsp;"]
    docs = spark.createDataFrame([(i, f"<p>{h}</p>{names}") for i, h in enumerate(heads)], "xml_index int, xml_text string")
    found = markup.extract_rows(docs, squash_headings=True)
    assert {r.xml_index for r in found.collect()} == {0, 1, 2}


def test_bodies_that_only_begin_like_an_archive(spark):
    files = [("1", b"PK plain text"), ("2", b"<result><status>013</status></result>")]
    df = spark.createDataFrame(files, "rcept_no string, content binary")
    single = {r.rcept_no: (r.xml_text, r.error) for r in unpack(df, plain_documents=True).collect()}
    assert single == {"1": ("PK plain text", None), "2": (None, "status 013")}
    assert {r.error.split(":")[0] for r in unpack(df).collect()} == {"bad archive"}


def test_looked_up_tags_give_the_nodes_that_matched_ones_give():
    random.seed(9)
    same = 0
    for _ in range(6000):
        text = "".join(random.choice(PIECES) for _ in range(random.randint(1, 12)))
        plain, matched = _Reader(any_of(WORDS)), _Reader(any_of(WORDS))
        if plain.read_plain(text):
            assert matched.read_well_formed(text), text
            assert [h[:2] for h in plain.hits] == [h[:2] for h in matched.hits], text
            assert [(t.name, t.pos) for t in plain.tags] == [(t.name, t.pos) for t in matched.tags], text
            texts = None if plain.silent else plain.stripped
            assert _tables(plain.tags, -1, texts) == _tables(matched.tags), text
            same += 1
    assert same > 300


def test_a_document_that_was_read_leaves_nothing_to_the_collector():
    read_nodes("<p>x</p>", any_of(["임원"]), "겸직")
    gc.collect()
    gc.disable()
    try:
        for _ in range(50):
            read_nodes("<p>가. 임원</p><table><tr><td>a</td><td>b</td></tr></table>", any_of(["임원"]), "겸직")
        assert gc.collect() < 50
    finally:
        gc.enable()


def test_squashed_texts_without_a_word_stay_in_the_worker(spark):
    df = spark.createDataFrame([("<p>가.&nbsp;&quot;임 원&quot;</p><p>x</p><table><tr><td>a b</td></tr></table>",)], "t string")
    found = df.select(markup.markup_nodes(F.col("t"), ["가.임원"], behind_hits=True, squashed=True).alias("n")).first().n
    assert [t.text for t in found.texts] == ["가.임원"] and [t.text for t in found.tables] == ["a b"]


def test_archives_are_handed_on_in_small_portions():
    body = zipped([("a.xml", ("x" * 300_000).encode())])
    given = pa.RecordBatch.from_pydict({"rcept_no": [str(i) for i in range(20)], "content": [body] * 20})
    portions = list(_unpacked([given], False))
    assert max(p.nbytes for p in portions) < 3_000_000
    assert [n for p in portions for n in p.column(0).to_pylist()] == [str(i) for i in range(20)]


def test_entries_read_directly_are_those_that_zipfile_reads():
    random.seed(4)
    read = 0
    for i in range(1500):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", random.choice([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])) as z:
            for n in random.sample(["a.xml", "b.xml", "\u00e9.xml"], random.randint(1, 3)):
                z.writestr(n, random.randbytes(random.randint(0, 30)) + b"ab" * random.randint(0, 30))
        data = bytearray(body.getvalue())
        if i % 2:
            data[random.randrange(len(data))] = random.randrange(256)
        try:
            archive = zipfile.ZipFile(io.BytesIO(data))
        except Exception:
            continue
        bounds = [*sorted(e.header_offset for e in archive.infolist()), archive.start_dir]
        for info in archive.infolist():
            found = _plain_entry(info, bytes(data), bounds)
            if found is not None:
                assert archive.read(info) == found
                read += 1
    assert read > 1000


def test_ordinary_archives_are_read_without_zipfile_as_zipfile_reads_them(monkeypatch):
    def packed(kind, comment=b""):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", kind) as z:
            for name in ("b.xml", "a.xml", "d/c.xml"):
                z.writestr(name, f"{name} 임원의 현황 {kind}".encode("euc-kr"))
            z.comment = comment
        return body.getvalue()

    rng = random.Random(5)
    archives = [packed(zipfile.ZIP_STORED), packed(zipfile.ZIP_DEFLATED), packed(zipfile.ZIP_STORED, b"note")]
    odd = []
    for _ in range(3000):
        data = bytearray(rng.choice(archives))
        data[rng.randrange(len(data))] = rng.choice([0, 1, 8, 80, 255])
        odd.append(bytes(data[rng.choice([0, 0, 0, 3]) : len(data) - rng.choice([0, 0, 0, 1])]))
    got = [list(_entries(data, False)) for data in odd]
    with monkeypatch.context() as m:
        m.setattr(sources, "_directory", lambda data: None)
        assert got == [list(_entries(data, False)) for data in odd]
    whole = [list(_entries(data, False)) for data in archives]
    assert whole[0] == [(i, n, f"{n} 임원의 현황 0", None) for i, n in enumerate(("a.xml", "b.xml", "d/c.xml"))]
    monkeypatch.setattr(zipfile, "ZipFile", None)
    assert [list(_entries(data, False)) for data in archives[:2]] == whole[:2]


def test_filings_are_packed_as_zipfile_packs_them():
    for entries in ([], [(b"1.xml", b"")], [(b"1.xml", "임원의 현황".encode("euc-kr")), (b"0.xml", b"<p></p>" * 9999)]):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as z:
            for name, content in entries:
                z.writestr(zipfile.ZipInfo(name.decode()), content)
        assert stored_zip(entries) == body.getvalue()
