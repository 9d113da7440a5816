"""Frequent lines against plain Python."""

import random

import brute
import pytest
from rows import frame, odd_documents

from filingweave.llm import line_dedup as lines
from filingweave.llm.common import ready


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def line_documents(seed=5):
    """Lines shared by two to many documents, with odd ends, cases, repeats, short ones and rows without an id."""
    rng = random.Random(seed)
    pool = [f"Common line number {i} with some words" for i in range(12)] + ["short", "", "é" * 19, "é" * 20, "日本" * 10]
    rows = []
    for d in range(90):
        own = [f"only document {d} has line {i} of its text" for i in range(rng.randrange(4))]
        picked = [rng.choice(pool) for _ in range(rng.randrange(6))]
        odd = [rng.choice([" ", "\t", "\r", "\x0b\x0c", "\xa0", ""]) + line.swapcase() + rng.choice(["", "\r", "  "]) for line in picked]
        text = own + odd
        rng.shuffle(text)
        rows.append((d, "\n".join(text)))
    hot = "a line that a third of all documents have"
    rows += [(200 + i, hot) for i in range(45)] + [(300, None), (301, ""), (302, "\n\n"), (303, "\n" + hot + "\n")]
    rows += [(None, hot + "\nonly a row without an id has this"), (None, None), (None, hot)]
    return rows + [rows[5], rows[5], (5, "another text of document five\n" + hot)] + [(400, "\n".join([hot] * 500 + ["end"]))]


@pytest.mark.parametrize(("batches", "fan_in"), [(1, 2), (4, 2), (7, 3)])
def test_frequent_lines_stay_in_the_largest_document_only(session, batches, fan_in):
    rows = line_documents()
    got = lines.drop_repeated_lines(frame(session, rows), batches=batches, fan_in=fan_in)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.line_dedup(rows), key=repr)


def test_prose_and_an_empty_table(session):
    rows = odd_documents()
    got = lines.drop_repeated_lines(frame(session, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.line_dedup(rows), key=repr)
    assert lines.drop_repeated_lines(frame(session, rows).limit(0)).collect() == []


def test_text_ids_and_other_thresholds(session):
    rows = [(f"d{i}", f"line of document\n{'x' * (i % 3)}\nunique {i}") for i in range(20)]
    docs = session.createDataFrame(rows, "name string, body string")
    got = lines.drop_repeated_lines(docs, "name", "body", min_chars=1, min_docs=7, batches=3)
    assert sorted(map(tuple, got.collect())) == sorted(brute.line_dedup(rows, 1, 7))


def test_a_very_long_text(session):
    long = "\n".join(f"line {i % 1000} of a very long text, some fifty characters" for i in range(400_000))
    rows = [(1, long), (2, long), (3, long + "\nend")]
    got = {r.doc_id: r for r in lines.drop_repeated_lines(session.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_dropped, got[2].text, got[3].n_dropped) == (400_000, "", 0)


def test_full_levels_are_compacted_and_keys_stay_distinct(session):
    runs = lines.Runs(session, 4, 2)
    for n in range(5):
        keys = session.range(n * 50, n * 50 + 100).selectExpr("id as h1", "-id as h2", "1L as n")
        seen = runs.seen(keys)
        assert seen.where("seen").count() == (50 if n else 0)
        runs.add(seen)
        runs.compact()
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    total = runs.total().collect()
    assert len(total) == len({r.h1 for r in total}) == 300 and sum(r.n for r in total) == 500
    plan = runs.seen(session.range(9).selectExpr("id as h1", "-id as h2"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange hashpartitioning") <= 1
    runs.close()
