"""Top-k, language model, toxicity, urls and passages."""

import itertools
import math
import random
from collections import Counter

import brute
import numpy as np
import pytest
from rows import frame, odd_documents, words

from filingweave.llm import gated, passages
from filingweave.llm import toxicity as tox
from filingweave.llm.common import ready
from filingweave.llm.language_model import lm_scores
from filingweave.llm.topk import top_products
from filingweave.llm.url_filter import RULES, best_split, url_verdicts


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


# --- top-k


def vectors(session, rows):
    return session.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id long, embedding array<double>, rank int, v string").repartition(3)


def best(rows, k=5, every=50, scale=256):
    fine = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in fine:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, qv in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in fine if i != q)[:k]
        out += [(q, r + 1, i, min(2**63 - 1, max(-(2**63), -s))) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_products_equal_brute_force(session):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(9)]) for i in range(400)]
    rows += [(i, rows[i - 400][1]) for i in range(400, 420)]  # ties
    rows += [(0, rows[0][1]), (7, rows[7][1]), (500, [0.0] * 9), (550, None), (600, [None] * 9), (650, [float("nan")] * 9)]
    rows += [(700, [float("inf")] * 9), (None, rows[3][1]), (750, [-0.001] * 9), (751, [0.5, -0.5])]
    got = top_products(vectors(session, rows), block_rows=64, block_queries=4, at_once=2)
    assert sorted(map(tuple, got.collect())) == best(rows)


def test_top_products_of_large_components_few_rows_and_none(session):
    rows = [(0, [1e9, -3e5]), (50, [2.0, 1.0]), (3, [-1e9, 7.0]), (4, [1.0, 1.0])]
    assert sorted(map(tuple, top_products(vectors(session, rows)).collect())) == best(rows)
    assert top_products(vectors(session, [(50, [1.0])])).count() == 0
    assert top_products(vectors(session, [])).count() == 0


# --- language model


def small_model(seed=2):
    rng = np.random.default_rng(seed)
    weights = gated.fresh(np.arange(gated.HEAD, 0, -1).astype(float), 500.0)
    return {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in weights.items()}, rng


def test_gradients_are_those_of_the_loss():
    weights, rng = small_model()
    ids = rng.choice([0, 1, 2, 70, 4000, gated.TAIL], (5, 3))
    state = rng.normal(0, 0.5, (3, gated.UNITS)).astype(np.float32)

    def loss(w):
        out = gated.Steps(w).run(ids, ids == 1, state)
        return -gated.log_likelihood(w, out.reshape(-1, gated.UNITS), ids.ravel()).mean(dtype=np.float64)

    steps = gated.Steps(weights)
    out = steps.run(ids, ids == 1, state)
    grads = {}
    back = gated.output_gradients(weights, out.reshape(-1, gated.UNITS), ids.ravel(), grads)
    d_in, grads["state"] = steps.back(back.reshape(out.shape))
    grads["gate"] = d_in.reshape(-1, 3 * gated.UNITS).sum(axis=0)
    found, rows = gated.summed_by_word(ids.ravel(), d_in.reshape(-1, 3 * gated.UNITS))
    grads["input"] = np.zeros_like(weights["input"])
    grads["input"][found] = rows
    for name, grad in grads.items():
        for at in np.argsort(-np.abs(grad.ravel()))[:4]:
            where, ends = np.unravel_index(at, grad.shape), []
            for sign in (1, -1):
                moved = {k: v.astype(np.float64) for k, v in weights.items()}
                moved[name][where] += sign * 1e-3
                ends.append(loss({k: v.astype(np.float32) for k, v in moved.items()}))
            assert abs((ends[0] - ends[1]) / 2e-3 - grad[where]) < 2e-3 + 0.05 * abs(grad[where]), name


def test_probabilities_sum_to_one_and_state_is_carried():
    weights, rng = small_model()
    state = rng.normal(0, 1, (1, gated.UNITS)).astype(np.float32)
    everything = np.arange(gated.HEAD + 1)
    total = np.exp(gated.log_likelihood(weights, np.repeat(state, len(everything), 0), everything)).sum()
    assert abs(total - 1) < 1e-3
    texts = [np.append(rng.integers(1, gated.HEAD + 1, n), 0).astype(np.int32) for n in (0, 1, 5, 40, 333, 90)]
    several = gated.scores(weights, texts, end=0, window=8, streams=2)
    for text, got in zip(texts, several):
        once = gated.scores(weights, [text], end=0, window=10_000)
        assert abs(once[0] - got) < 1e-2
        h, total = np.zeros((1, gated.UNITS), np.float32), 0.0  # step by step
        for word, target in zip(np.append(0, text[:-1]), text):
            h = gated.Steps(weights).run(np.array([[word]]), np.array([[False]]), h)[-1]
            total += gated.log_likelihood(weights, h, np.array([target]))[0]
        assert abs(total - got) < 1e-2


def test_language_model_scores(session):
    rng = random.Random(3)
    rows = []
    for i in range(300):  # two languages: what came before tells which words follow
        tongue = rng.choice("xy")
        rows.append((i, " ".join(f"{tongue}{int(rng.paretovariate(1)) % 300}" for _ in range(rng.randrange(5, 120)))))
    rows += [(i + 300, t) for i, t in odd_documents() if i is not None] + [(None, "x1 x2"), (901, "never seen before")]
    got = {}
    for r in lm_scores(frame(session, rows)).collect():
        got.setdefault(r.doc_id, r)
    want = brute.unigram(rows)
    assert len(got) == len(want)
    for doc, (held, n, known, total, base) in want.items():
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    held = [r for d, r in got.items() if r.held_out and d is not None and d < 300]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)
    assert lm_scores(frame(session, [])).count() == 0
    alone = lm_scores(frame(session, [(i, "a b") for i in range(50) if brute.remainder(i, 5) == 1])).collect()
    assert alone and all(r.train_tokens == 0 and r.score == r.base_score == 0 for r in alone)


# --- toxicity


def labelled(session, rng, n=500):
    docs, marks = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        text = words(rng, rng.randrange(20, 120), 400)
        for _ in range(rng.randrange(2, 5) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["awful", "nasty", "vile"]))
        docs.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    return docs, marks


def labels(session, marks):
    return session.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity_on_documents_it_has_not_seen(session):
    docs, marks = labelled(session, random.Random(1))
    docs += [(1000, None), (1001, ""), (1002, "--- ..."), (None, "vile vile"), (5, docs[5][1])]
    more = [*marks, (5, None), (None, 1), (7777, 1), marks[6]]
    got = tox.toxicity(frame(session, docs), labels(session, more)).collect()
    assert len(got) == len(docs)
    truth = dict(marks)
    seen = [r for r in got if r.doc_id in truth]
    assert all(r.held_out == (brute.remainder(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    right = [r.predicted == truth[r.doc_id] for r in seen if r.held_out]
    assert sum(right) / len(right) > 0.9
    assert all(not r.predicted for r in got if r.doc_id in (1000, 1001, 1002))
    # labels of documents kept out have no say
    flipped = [(i, 1 - t if brute.remainder(i, 4) == 2 else t) for i, t in marks]
    again = tox.toxicity(frame(session, docs), labels(session, flipped)).collect()
    assert sorted((repr(r.doc_id), round(r.score, 9)) for r in again) == sorted((repr(r.doc_id), round(r.score, 9)) for r in got)
    kept = tox.without_toxic(frame(session, docs), labels(session, more))
    assert kept.count() == sum(not r.predicted for r in got) and len(kept.columns) == 12


@pytest.mark.parametrize("marks, score", [([], 0.0), ([(1, 0), (0, 0)], 0.0), ([(1, 1), (0, 1)], 1.0)])
def test_toxicity_without_labels_of_both_classes(session, marks, score):
    got = tox.toxicity(frame(session, [(0, "a"), (1, None), (2, "b")]), labels(session, marks)).collect()
    assert {r.score for r in got} == {score} and len(got) == 3
    assert tox.toxicity(frame(session, []), labels(session, [])).count() == 0


# --- urls


def test_viterbi_finds_the_best_of_all_splits():
    known = {"free": math.log(0.1), "bets": math.log(0.05), "freebie": math.log(0.001), "be": math.log(0.01), "ts": math.log(0.02)}
    total = 1000.0
    for piece in ("freebets", "betsfree", "xfree", "freebe", "q", "bebets"):

        def value(split):
            return sum(known.get(w, math.log(10 / total) - len(w) * math.log(10)) for w in split)

        splits = []
        for n in range(len(piece)):
            for cuts in itertools.combinations(range(1, len(piece)), n):
                ends = [0, *cuts, len(piece)]
                splits.append([piece[a:b] for a, b in zip(ends, ends[1:])])
        assert abs(value(best_split(piece, known, total)) - max(map(value, splits))) < 1e-9
    assert best_split("freebets", known, total) == ["free", "bets"]


def test_url_verdicts(session):
    urls = [
        "http://a.example.net/en/1", "HTTP://A.Example.NET/fr/1", "https://net/x", "https://xnet/y", "https://m.example.com/de/2",
        "https://example.com/de", "https://b.org/fr/x?q=/de/", "https://b.org?x=1", "http://b.org#t", "http://b.org", "nothing", None, "", "://x.net/",
        "http://h.net:80/en/", "a://b://c.net/", "https://freebets.example.com/en/5", "https://casinowin.example.com/en/6", "http://x.net",
        "http://" + "long" * 100 + ".org/a", "http://ä.org/fr/",
    ]
    urls += [f"https://news{i % 9}.example.com/en/{i}" for i in range(60)] + ["https://free-bets.example.com/en/7"] * 3
    html = "<html><script>free</script><p>free news and win free news casino cheap win</p></html>"
    rows = [(i, u, html if i % 3 else None, "x", 1.0) for i, u in enumerate(urls)] + [(None, urls[0], html, "x", 1.0)]
    pages = session.createDataFrame(rows, "page_id long, url string, html string, host string, log_odds double").repartition(3)
    got = url_verdicts(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule) == brute.ruled(urls[r.page_id], RULES)[:3], urls[r.page_id]
            said = brute.ruled(urls[r.page_id], RULES)[3]
            assert r.verdict == said if said else r.verdict in ("allow", "block")
    by_url = {urls[r.page_id]: r.verdict for r in got if r.page_id is not None}
    assert by_url["https://freebets.example.com/en/5"] == by_url["https://casinowin.example.com/en/6"] == "block"
    assert by_url["https://news1.example.com/en/1"] == "allow"
    assert url_verdicts(pages.where("false")).count() == 0


# --- passages


def test_minimizers_meet_in_equal_runs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b, run = (rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (60, 80, 16))
        both = [np.concatenate([a[:20], run, a[20:]]), np.concatenate([b[:50], run, b[50:]])]
        starts = np.array([0, len(both[0]), len(both[0]) + len(both[1])])
        at, value = passages.minimizers(np.concatenate(both), starts)
        mine = {v: p for p, v in zip(at, value) if p < starts[1]}
        assert any(v in mine and mine[v] - 20 == p - starts[1] - 50 for p, v in zip(at, value) if p >= starts[1])


def chain_value(p, r, chain, k, cost):
    return k * len(chain) - cost * sum(p[i] - p[j] + r[i] - r[j] for j, i in zip(chain, chain[1:]))


def test_fenwick_chains_equal_quadratic_dynamic_programming():
    rng = random.Random(7)
    for _ in range(40):
        n = rng.randrange(2, 14)
        p = np.array(sorted(rng.randrange(60) for _ in range(n)))
        r = np.array([rng.randrange(60) for _ in range(n)])
        best = [5.0] * n
        for i in range(n):
            for j in range(i):
                if p[j] < p[i] and r[j] < r[i]:
                    best[i] = max(best[i], best[j] + chain_value(p, r, [j, i], 5, 0.1) - 5)
        found = passages.chains(p, r, gap=10_000)
        assert sorted(i for c in found for i in c) == list(range(n)) or (r - p == r[0] - p[0]).all()
        assert abs(max(chain_value(p, r, c, 5, 0.1) for c in found) - max(best)) < 1e-9


def test_planted_passages_are_found(session):
    rng = random.Random(5)
    shared = [words(rng, 60) for _ in range(4)]
    fuzzy = list(shared[0])
    fuzzy[20], fuzzy[41:43] = "other", []
    rows = [(i, " ".join(words(rng, 90) + s + words(rng, 30))) for i, s in enumerate([shared[0], shared[1], shared[0], fuzzy, shared[2]])]
    rows += [(10, " ".join(shared[2])), (11, " ".join(shared[3] + words(rng, 5) + shared[3])), (12, " ".join(words(rng, 200)))]
    rows += [(13, " ".join(words(rng, 20) + shared[1][:40] + words(rng, 20))), (14, None), (15, ""), (None, " ".join(shared[0])), (2, rows[2][1])]
    rows += [(i, " ".join(shared[3])) for i in range(20, 60)]
    got = {}
    for r in passages.shared_passages(frame(session, rows)).collect():
        got.setdefault(r.doc_id, set()).add((r.passage_start, r.passage_stop))
    assert got.pop(2) == {(90, 150)} and got.pop(10) == {(0, 60)}
    (found,) = got.pop(3)
    assert found == (90, 148)
    assert got == {i: {(0, 60)} for i in range(20, 60)}
    docs = frame(session, rows)
    cut = passages.cut_passages(docs, passages.shared_passages(docs), length_col="n").collect()
    texts = {r.doc_id: r.text for r in cut}
    assert texts[2].split() == rows[2][1].split()[:90] + rows[2][1].split()[150:]
    assert all(texts[i] == dict(rows[:13])[i] for i in (0, 1, 4, 11, 12)) and not set(texts) & {10, *range(20, 60)}
    assert {r.n for r in cut if r.doc_id == 2} == {len(texts[2])} and len(cut) == len(rows) - 41
    assert passages.shared_passages(frame(session, [])).count() == 0


def test_copies_and_repetitive_texts_count_as_passages(session):
    rows = [(1, "go " * 300), (2, "go " * 300), (3, "a b c d e f g " * 30), (4, "a b c d e f g " * 30), (5, "go " * 40)]
    got = {r.doc_id: (r.passage_start, r.passage_stop) for r in passages.shared_passages(frame(session, rows)).collect()}
    assert got == {2: (0, 300), 4: (0, 210)}


def test_equal_runs_whose_seeds_all_stand_first_in_other_documents_are_found(session):
    rng = random.Random(8)
    rows, wanted = [], set()
    for n in range(0, 60, 6):
        run = words(rng, 50, 10**6)
        near = words(rng, 20, 10**6) + run + words(rng, 20, 10**6)
        rows += [(n, " ".join(run[:41] + words(rng, 40, 10**6))), (n + 1, " ".join(words(rng, 40, 10**6) + run[9:]))]  # all seeds, no passage
        rows += [(n + 2, " ".join(near)), (n + 3, " ".join(words(rng, 7, 10**6) + run))]
        rows += [(n + 4, " ".join(run[:49] + words(rng, 9, 10**6))), (n + 5, " ".join(run + words(rng, 30, 10**6) + run))]
        wanted |= {(n + 3, 7, 57), (n + 5, 0, 50), (n + 5, 80, 130)}
    found = passages.shared_passages(frame(session, rows).coalesce(1))
    assert {(r.doc_id, r.passage_start, r.passage_stop) for r in found.collect()} == wanted


def cut_words(session, rows):
    """Of each document the words that are in its passages."""
    got = {}
    for r in passages.shared_passages(frame(session, rows)).collect():
        assert r.words >= 50 and r.equal >= 0.8 * r.words
        got.setdefault(r.doc_id, set()).update(range(r.passage_start, r.passage_stop))
    return got


def test_seeds_that_stood_elsewhere_do_not_hide_a_passage(session):
    rng = random.Random(11)
    shared = words(rng, 60)
    early = [(i, " ".join(words(rng, 60) + shared[at : at + 9] + words(rng, 60))) for i, at in enumerate(range(0, 52, 5))]
    rows = [*early, (50, " ".join(words(rng, 30) + shared + words(rng, 30))), (51, " ".join(words(rng, 70) + shared + words(rng, 20)))]
    assert cut_words(session, rows)[51] >= set(range(70, 130))


def test_every_copy_inside_a_larger_document_is_a_passage(session):
    rng = random.Random(12)
    shared = words(rng, 60)
    rows = [(1, " ".join(words(rng, 30) + shared + words(rng, 30))), (2, " ".join(shared + words(rng, 90) + shared + words(rng, 40)))]
    rows += [(3, " ".join(words(rng, 20) + shared + words(rng, 20)))]
    assert cut_words(session, rows) == {2: {*range(60), *range(150, 210)}, 3: set(range(20, 80))}


def test_passages_with_many_differing_words_are_found(session):
    rng = random.Random(13)
    found, rows, n = set(), [], 100
    for i in range(n):  # nine or ten of 60 words differ: 0.83 to 0.85 equal
        shared = words(rng, 60, 10**6)
        fuzzy = list(shared)
        for at in rng.sample(range(60), 9 + i % 2):
            fuzzy[at] = "other"
        rows += [(i, " ".join(words(rng, 40, 10**6) + shared)), (n + i, " ".join(words(rng, 40, 10**6) + fuzzy + words(rng, 40, 10**6)))]
    found = cut_words(session, rows)
    assert sum(len(found.get(n + i, set()) & set(range(40, 100))) >= 50 for i in range(n)) > 90


def test_short_lines_of_different_documents_are_no_passage(session):
    rng = random.Random(14)
    one, two = words(rng, 30), words(rng, 30)
    rows = [(1, " ".join(words(rng, 50) + one)), (2, " ".join(two + words(rng, 50))), (3, " ".join(one + two))]
    assert cut_words(session, rows) == {}


def test_packed_columns_round_trip():
    rng = np.random.default_rng(3)
    for kind in (1, 200, 70_000, 1 << 40):
        columns = [rng.integers(-kind, kind, 30), np.full(30, kind), rng.integers(0, 5, 30).astype(np.int32), rng.integers(0, 1 << 32, 30).astype(np.uint32)]
        assert [c.tolist() for c in passages._unpacked(passages._packed(columns))] == [c.tolist() for c in columns]


def test_sketches_hold_the_words_on_either_side():
    rng = random.Random(4)

    def bits(line):
        found = 0
        for w in line.tolist():
            found |= 1 << (w & 63)
        return found - (1 << 64) if found >> 63 else found

    for n in (0, 3, 12, 40, 90):
        line = np.array([rng.randrange(1 << 32) for _ in range(n)], "<u4")
        of = passages.around(line, 21, 12)
        for lo in range(n):
            for hi in range(lo, n + 1, 5):
                front, behind = bits(line[max(0, lo - 21) : lo]), bits(line[hi : hi + 21])
                assert of(lo, hi) == (front if lo >= 12 else 0, behind if n - hi >= 12 else 0)
        assert of(n + 500, n + 505) == (0, 0)  # a place in another text of the same id


def test_sketches_drop_no_passage(session, monkeypatch):
    rng = random.Random(15)
    rows = []
    for i in range(120):  # every fifth word differs, or as many in a row, so that most chains are short
        shared = words(rng, 60, 10**6)
        fuzzy = [f"x{rng.randrange(10**6)}" if (at % 5 == i % 5 if i % 2 else 20 <= at < 20 + i % 9) else w for at, w in enumerate(shared)]
        rows += [(i, " ".join(words(rng, 30, 400) + shared)), (200 + i, " ".join(words(rng, 40, 400) + fuzzy + words(rng, i % 40, 400)))]
    got = sorted(map(tuple, passages.shared_passages(frame(session, rows)).collect()))
    monkeypatch.setattr(passages, "hopeful", lambda docs, found, *rest: found)
    assert got and got == sorted(map(tuple, passages.shared_passages(frame(session, rows)).collect()))


def test_texts_without_words():
    text = "one two\n three  four\tfive "
    assert passages.without_words(text, [(1, 3)]) == "one  four\tfive "
    assert passages.without_words(text, [(0, 2), (1, 9)]) == " "
    assert Counter(passages.without_words(text, []))[" "] == text.count(" ")


def test_seeds_sort_by_key_as_a_stable_sort_does():
    rng = np.random.default_rng(6)
    for n, kinds in ((0, 1), (1, 1), (900, 40), (900, 1 << 62)):
        key = rng.integers(0, kinds, n).astype(np.uint64)
        assert passages.by_key(key).tolist() == np.argsort(key, kind="stable").tolist()
    key = np.uint64(1 << 63) + rng.integers(0, 30, 900).astype(np.uint64)  # only the bits that the index takes differ
    assert passages.by_key(key).tolist() == np.argsort(key, kind="stable").tolist()
    doc, pos = rng.integers(-9, 9, 900), rng.integers(0, 50, 900).astype(np.int32)
    for far in (1, 1 << 58):
        assert passages.by_place(doc * far, pos).tolist() == np.lexsort((pos, doc)).tolist()


def test_parts_packed_at_once_are_those_packed_one_by_one():
    rng = np.random.default_rng(4)
    columns = [rng.integers(-(1 << 40), 1 << 40, 300), np.repeat([5, 1 << 33, -2], 100), rng.integers(0, 300, 300).astype(np.uint32)]
    cuts = np.array([0, 1, 100, 250])
    parts = passages._packed_parts(columns, cuts)
    assert parts == [passages._packed([c[i:j] for c in columns]) for i, j in zip(cuts, [1, 100, 250, 300])]
    assert [c.tolist() for c in passages._unpacked_parts(parts)] == [c.tolist() for c in columns]


def test_small_buckets_leave_in_few_batches():
    schema = passages.pa.schema([("a", passages.pa.int64()), ("b", passages.pa.int32())])
    parts = [[np.arange(n), np.full(n, n, np.int32)] for n in (3, 0, 4, 5, 1)]
    out = list(passages._filled(iter(parts), schema, rows=7))
    assert [b.num_rows for b in out] == [7, 6] and sum((b.column(0).to_pylist() for b in out), []) == [i for p in parts for i in p[0]]
    assert list(passages._filled(iter(parts[1:2]), schema)) == []
