"""Aligned tokenizers against plain Python over the libraries."""

import hashlib
import random

import brute
import public_tokenizers
import pytest
from rows import frame, odd_documents

from filingweave.llm import alignment as al
from filingweave.llm.common import ready

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def tuples(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


def odd_texts(seed=4):
    rng = random.Random(seed)
    bits = ["word", "Größe", "日本語", "😀", "naïve", "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "1234567", "!!!", "it's"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", " \n", "\t", "\u00a0", "\r\n", "   "]
    rows = []
    for d in range(150):
        text = "".join(rng.choice(bits) + rng.choice(gaps) for _ in range(rng.randrange(12)))
        rows.append((d, rng.choice(["", " ", "\n", "x"]) + text + rng.choice(["", " ", "y"])))
    rows += [(200, "a▁b"), (201, "▁"), (202, " "), (203, "x" * 5000), (204, "\x00 \x1f a\x85b"), (205, "fi ﬁ Å Å ½"), (206, "e\u0301 \u200b \ufeff \u180e x")]
    return rows + [(None, "no id"), (None, None), (207, ""), rows[7], rows[7], (8, "another text with the id of eight")]


@pytest.mark.parametrize("known", [0, 40, 1 << 18])
def test_alignments_equal_brute_force(session, known):
    rows = odd_texts()
    got = al.alignments(frame(session, rows), A, B, known=known, remembered=50).cache()
    assert tuples(got) == sorted(brute.token_alignment(rows, A, B), key=repr)
    for r in got.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")


def test_prose_and_an_empty_table(session):
    rows = odd_documents()
    assert tuples(al.alignments(frame(session, rows), A, B)) == sorted(brute.token_alignment(rows, A, B), key=repr)
    assert al.alignments(frame(session, rows).limit(0), A, B).collect() == []


def test_prose_of_the_tables(session):
    docs = session.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert tuples(al.alignments(docs, A, B)) == sorted(brute.token_alignment([tuple(r) for r in docs.collect()], A, B), key=repr)


def test_a_long_text_in_stretches_is_the_text_in_one(session, monkeypatch):
    rows = [(d, t) for d, t in odd_texts() if t] + [(900, "good words here " * 50 + "▁ and more")]
    want = brute.token_alignment(rows, A, B)
    words = al.Words(al.Aligner(A, B), 10)
    monkeypatch.setattr(al, "_STRETCH", 20)
    for (_, text), (_, n_a, n_b, n_groups, n_links, _, _, groups) in zip(rows, want):
        found = [(words.figures[n].sum(axis=0), ";".join(words.groups[i] for i in n)) for _, n in words.document(text)]
        assert ";".join(g for _, g in found) == groups
        assert [int(sum(f[i] for f, _ in found)) for i in range(4)] == [n_a, n_b, n_groups, n_links]


def test_words_aligned_together_equal_words_aligned_alone():
    """One call of the first tokenizer for all plain words, whatever stands between them."""
    calls = []

    class Counted:
        def __init__(self, words):
            self.words = words

        def encode_ordinary(self, text):
            calls.append(text)
            return self.words.encode_ordinary(text)

    words = list(dict.fromkeys(w for _, t in odd_texts() for w in (t or "").split(" ") if w))
    words += ["a\nb", "two  gaps", "\u2028x", "\x1c", "x" * 2001, "ﬁ", "word's", "'s", "１２", "日本", "\u0301x"]
    align, alone = al.Aligner(A, B), {}
    for word in words:
        alone[word] = brute.token_alignment([(1, word)], A, B)[0]
    whole = align.a.words
    try:
        align.a.words = Counted(whole)
        found = align.align(words)
    finally:
        align.a.words = whole
    assert sorted(found.words) == sorted(words) and not found.back.all()
    assert [tuple(f) for f in found.figures.tolist()] == [alone[w][1:5] for w in found.words]
    assert found.groups == [alone[w][7] for w in found.words] and len(found.pairs) == found.figures[:, 3].sum()
    assert len(calls) == 1 + sum(len(w) <= 2000 and bool(al._SPACE.search(w)) for w in words)
    assert align.align([]).words == [] and align.align(["a▁b"]).figures.tolist() == [[0, 0, 0, 0]]


def test_pair_counts_of_words_told_twice(session):
    rows = [("word", 3), ("naïve", 2), ("word", 4)]
    got = al.pair_counts(session.createDataFrame(rows, "word string, n long"), A, B)
    once = al.pair_counts(session.createDataFrame([("word", 7), ("naïve", 2)], "word string, n long"), A, B)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, once.collect())) != []


def test_a_very_long_text(session):
    text = "a very long text of common words and naïve ones\n" * 300_000
    got = al.alignments(session.createDataFrame([(1, text)], "doc_id long, text string"), A, B, with_groups=False).first()
    small = al.alignments(session.createDataFrame([(1, text[: len(text) // 100_000])], "doc_id long, text string"), A, B).first()
    assert got.n_groups == small.n_groups * 100_000 and got.n_links == got.n_a + got.n_b - got.n_groups
