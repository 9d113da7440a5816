"""The pipeline's stages against plain Python, and the registered queries."""

import os
import random
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T
from rows import words
from test_llm_documents import BPE, contaminated_documents
from pyspark.sql import functions as F
from test_llm_models import labelled

import __spark_entry__ as contract
from filingweave.llm.common import ready
from filingweave.llm.packing import encoder
from filingweave.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, k string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents of every stage's kind, their labels and a benchmark, as tables in a folder."""
    ready(spark)
    rng = random.Random(8)
    clean, marks = labelled(None, rng, 300)
    odd, bench = contaminated_documents()
    shared = words(rng, 70)
    docs = [(i + 1000, t) for i, t in clean]
    docs += [row for row in odd if row[0] is not None]
    docs += [(2000 + i, " ".join(words(rng, 90) + shared + words(rng, 20))) for i in range(6)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "xx", "s", None if t is None else len(t), 1.5, "c") for i, t in docs]
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i + 1000, 1, m) for i, m in marks], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict((i + 1000, m) for i, m in marks), bench


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def long_runs(docs, n=50):
    """Documents that hold ``n`` words in a row that a document with a smaller id holds, too."""
    first, found = {}, Counter()
    for d, t in sorted(docs):
        w = brute.space_words(t)
        for i in range(len(w) - n + 1):
            if first.setdefault(tuple(w[i : i + n]), d) != d:
                found[d] += 1
    return found


def test_stages(spark, corpus, tmp_path):
    folder, toxic, bench = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = pairs(docs)
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{n}")
        out = spark.read.parquet(f"{tmp_path}/{n}")
        if name == "packing":
            ids = defaultdict(list)
            for r in out.collect():
                ids[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
            for d, t in before:
                want = np.frombuffer(encoder(BPE)(t), "<u4").tolist() + [0]
                assert [i for _, part in sorted(ids[d]) for i in part] == want
            assert set(ids) == {d for d, _ in before}
            assert sorted((r.doc_id, r.sequence_id, r.offset) for r in corpus_pipeline.run(spark, folder).collect())
            return
        after = pairs(out)
        if name == "toxicity":
            assert set(after) <= set(before)
            gone = {d for d, _ in before} - {d for d, _ in after}
            assert sum(toxic.get(d) == 1 for d in gone) > 0.9 * sum(toxic.values())
            assert sum(toxic.get(d) != 1 for d in gone) < 0.05 * len(before)
        elif name == "near_duplicates":
            kept = {c for _, _, c in brute.simhash(before)}
            assert sorted({d for d, _ in after}) == sorted(kept) and len(after) == len(kept)
        elif name == "substrings":
            texts = dict(before)
            assert long_runs(before) and not long_runs(after)
            cut = [d for d, t in after if t != texts[d]]
            assert set(cut) <= set(long_runs(before)) and all(r.n_chars == len(r.text) for r in out.where("text is not null").collect())
        else:
            bad = {d for d, *_, is_bad in brute.decontaminated(before, bench) if is_bad}
            assert bad and after == [row for row in before if row[0] not in bad]
        docs = out


def test_passages_of_rows_without_an_id_of_their_own_are_cut(spark):
    rng = random.Random(3)
    line = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    shared, heads = line(60), [line(30) for _ in range(4)]
    rows = [(1, f"{heads[0]} {shared}"), (None, f"{heads[1]} {shared}"), (2, heads[2] + " " + line(90)), (2, f"{heads[3]} {shared}")]
    out = corpus_pipeline.substrings(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [rows[0], (None, heads[1]), rows[2], (2, heads[3])]))


def test_columns_of_any_name_keep_their_values(spark, corpus):
    """Names that the row filters use inside, in a table that has them all."""
    folder, _, _ = corpus
    names = ["_key", "_K", "_id", "_spans", "_row", "_kept", "_bad", "_extra", "_number", "_text", "fp", "doc", "t", "first", "root"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").drop("score", "k")
    extra = docs.select("*", *[F.concat_ws("-", F.lit(n), "doc_id").alias(n) for n in names])
    extra = extra.unionByName(extra.where("doc_id = 2003").withColumn("text", F.concat("text", F.lit(" another text of this id"))))
    plain = extra.select(docs.columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, folder)
        assert out.columns == extra.columns
        rows = out.collect()
        assert all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names), name
        assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == pairs(stage(spark, plain, folder)), name


def test_an_empty_corpus_passes_all_stages(spark, corpus, tmp_path):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name


def test_queries_are_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and {*QUERIES, "pipeline"} <= set(names)
    assert set(SQL) <= set(contract.oracle_sql()) and [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None


COLUMNS = {
    "op1": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op3": {"page_id", "host", "path", "rule", "verdict"},
    "op4": {"query_id", "rank", "vec_id", "score"},
    "op5": {"doc_id", "held_out", "score", "predicted"},
    "op6": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op7": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op9": {"doc_id", "fingerprint", "component_id"},
    "op10": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op11": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "op12": {"word", "form", "root", "n", "n_near", "form_n"},
    "op13": {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_over_the_whole_table(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert COLUMNS.get(name.split("_")[0], {"doc_id"}) <= set(df.columns)
    assert not any(isinstance(f.dataType, T.NullType) for f in df.schema)
    rows = df.count()
    if name.startswith(("op1_", "op2", "op5", "op7", "op9", "op10", "op11", "op13")):
        assert rows == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if name in SQL:
        con = duckdb.connect()
        for f in os.listdir(FOLDER):
            con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
        found = con.execute(SQL[name])
        names = [d[0] for d in found.description]
        assert Counter(map(tuple, df.select(names).collect())) == Counter(map(tuple, found.fetchall()))
