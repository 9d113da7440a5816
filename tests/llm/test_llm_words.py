"""Spelling variants against plain Python."""

import itertools
import random
import time
import zlib

import brute
import numpy as np
import pytest
from rows import frame, odd_documents
from pyspark.sql import functions as F

from filingweave.llm import variants as var
from filingweave.llm.common import ready


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def edited(rng, word, letters="abcé"):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(letters) + word[at:]
    at = min(at, len(word) - 1)
    return word[:at] + (rng.choice(letters) if kind == 1 else "") + word[at + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abcdé", "ÿa"])
def test_a_sorted_list_gives_all_pairs_one_edit_apart(letters):
    rng = random.Random(len(letters))
    parts = {"", "a", "aa"} | {"".join(rng.choice(letters) for _ in range(rng.randrange(9))) for _ in range(250)}
    parts |= {edited(rng, p, letters) for p in list(parts) if p}
    parts = sorted(parts)
    want = {(i, j) for i, j in itertools.combinations(range(len(parts)), 2) if brute.one_edit_apart(parts[i], parts[j])}
    got = list(var.near_in_list(parts))
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("largest", [1, 6, 50, 20_000])
def test_groups_of_any_size_give_each_pair_once(session, largest):
    rng = random.Random(largest)
    kinds = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(300)}
    kinds |= {"prefix" * 3 + w for w in list(kinds)[:120]} | {w + "suffix" * 3 for w in list(kinds)[:60]}
    kinds |= {edited(rng, w) for w in list(kinds)} - {""}
    found = var.near_pairs(session.createDataFrame([(w,) for w in kinds], "word string").repartition(3), largest).collect()
    got = [tuple(sorted(r)) for r in found]
    want = {tuple(sorted(p)) for p in itertools.combinations(kinds, 2) if brute.one_edit_apart(*p)}
    assert len(got) == len(set(got)) and set(got) == want


def tuples(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=repr)


def variant_documents(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéü") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    rows = []
    for d in range(120):
        text = []
        for _ in range(rng.randrange(60)):
            w = rng.choice(base[: rng.randrange(1, 41)])
            while rng.random() < 0.3:
                w = edited(rng, w)
            text.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((d, rng.choice([" ", "-", "1"]).join(text)))
    rows += [(500, None), (501, ""), (502, "× ÷ ××××× " * 3), (None, "nobody nobodi nobody"), (None, None)]
    rows += [(600 + i, "zorroq " * 3 + "zorraq " * 7 + "zarraq " * 15) for i in range(2)]  # a chain of forms
    return rows + [rows[3], rows[3], (3, "Größe GRÖSSE größe")]


@pytest.mark.parametrize("modulus", [97, 2])
def test_variants_equal_brute_force(session, modulus):
    rows = variant_documents()
    got = tuples(var.spelling_variants(frame(session, rows), modulus=modulus))
    assert got == sorted(brute.variants(rows, modulus=modulus), key=repr)
    assert any(form and root != form for _, _, _, form, _, root in got)


def test_prose_and_an_empty_table(session):
    rows = odd_documents()
    for min_chars, count in ((5, 3), (1, 1)):
        got = tuples(var.spelling_variants(frame(session, rows), min_chars=min_chars, min_count=count))
        assert got == sorted(brute.variants(rows, min_chars, count), key=repr)
    assert var.spelling_variants(frame(session, rows).limit(0)).collect() == []


def test_a_chain_of_forms_is_followed_to_the_end(session):
    chain = [("w" * n, "w" * (n + 1)) for n in range(1, 40)]
    got = dict(map(tuple, var.roots(session.createDataFrame(chain, "word string, form string")).select("word", "root").collect()))
    assert set(got.values()) == {"w" * 40} and len(got) == 39


def test_half_of_the_words_share_their_first_letters(session):
    words = session.range(3000).select(F.concat(F.lit("averylongcommonhead"), F.lpad(F.conv("id", 10, 16), 3, "0")).alias("word"))
    start = time.time()
    got = var.near_pairs(words, largest=100).count()
    hexes = [f"{i:03x}" for i in range(3000)]
    assert got == sum(brute.one_edit_apart(a, b) for a, b in itertools.combinations(hexes, 2))
    assert time.time() - start < 60


def test_very_long_texts_and_words(session):
    rows = [(1, "verylongtext " * 400_000), (2, "x" * 300_000 + " " + "x" * 300_001), (3, ("x" * 300_000 + " ") * 6), (4, ("x" * 300_001 + " ") * 3)]
    got = {r.word: r for r in var.spelling_variants(session.createDataFrame(rows, "doc_id long, text string")).collect()}
    long = got["x" * 300_000]
    assert (long.n_near, got["x" * 300_001].n_near) == (1, 1) and got["verylongtext"].n_near == 0


def test_checksums_of_id_and_word_come_from_those_of_each():
    starts = [zlib.crc32(f"{i}:".encode()) for i in ("", 7, -1, 10**12)]
    moved = var.moved_on(np.array(starts, np.uint32), 20)
    for word in ("", "a", "größe", "averylongwordindeed"):
        raw = word.encode()
        assert (moved[len(raw)] ^ np.uint32(zlib.crc32(raw))).tolist() == [zlib.crc32(raw, s) for s in starts]


def test_a_list_compares_neighbours_prefixes_once(monkeypatch):
    rng = random.Random(9)
    parts = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(300)})
    told, plain = [], var.common_prefix
    monkeypatch.setattr(var, "common_prefix", lambda a, b: told.append(1) or plain(a, b))
    want = {(i, j) for i, j in itertools.combinations(range(len(parts)), 2) if brute.one_edit_apart(parts[i], parts[j])}
    assert set(var.near_in_list(parts)) == want and len(told) < len(parts)
