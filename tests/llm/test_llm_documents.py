"""Sharding, fingerprints, decontamination, packing and token counts against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from rows import frame, odd_documents, words
from tokenizers import Tokenizer, models, pre_tokenizers

from filingweave.llm import common, passages
from filingweave.llm import simhash as sim
from filingweave.llm.common import ready
from filingweave.llm.decontamination import contamination, matches, without_contaminated
from filingweave.llm.packing import Packer, encoder, joined, pack
from filingweave.llm.sharding import shard_by_bytes
from filingweave.llm.token_counts import Counter as PieceCounter
from filingweave.llm.token_counts import read_pieces, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_are_contiguous_and_even(session, shards):
    rows = odd_documents()
    got = shard_by_bytes(frame(session, rows), shards).collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(sizes) <= set(range(shards))
    largest = max(r["size"] for r in got)
    assert all(abs(s - sum(sizes.values()) / shards) <= largest for s in sizes.values())
    keyed = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [(-1 if r.doc_id is None else r.doc_id) for r in keyed]
    assert ids == sorted(ids)


def test_one_text_in_a_third_of_the_rows_is_spread(session):
    rows = [(7, "same")] * 300 + [(i, "x" * 20) for i in range(600)]
    sizes = Counter()
    for r in shard_by_bytes(frame(session, rows), 9).collect():
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 36


def test_buckets_are_never_sent_to_all_tasks(session):
    """Each fingerprint stands in twenty buckets, but Spark takes these rows for as few as went in."""
    plan = sim.fingerprint_links(session.range(1000).select(F.xxhash64("id").alias("fp")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_simhash_equals_brute_force(session):
    rows = odd_documents()
    got = tuples(sim.near_duplicates(frame(session, rows)))
    assert got == sorted(brute.simhash(rows), key=repr)


@pytest.mark.parametrize("block", [4096, 16])
def test_linked_fingerprints_have_the_components_of_all_pairs(session, block):
    rng = random.Random(3)
    fps = {0, 1, 7, (1 << 64) - 1}
    for _ in range(12):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(25):  # chains that reach far beyond the radius
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                f ^= 1 << b
            fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = sim.fingerprint_links(session.createDataFrame(signed, "fp long"), block=block)
    assert all(0 < ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 3 for r in links.collect())
    found = {r.node: r.root for r in sim.components(links).collect()}
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    groups, mine = defaultdict(set), defaultdict(set)
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        groups[root(f)].add(s)
        mine[found.get(s, s)].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_bit_planes_count_differences():
    rng = random.Random(5)
    members = [rng.getrandbits(64) for _ in range(70)]
    members += [members[0] ^ 1, members[0] ^ 7, members[0] ^ 15]
    found = sim.within(members[0], sim.planes(members), (1 << len(members)) - 1)
    assert [i for i in range(len(members)) if found >> i & 1] == [i for i, m in enumerate(members) if (m ^ members[0]).bit_count() <= 3]


def test_one_document_of_each_group_stays(session):
    rows = odd_documents()
    kept = sim.one_of_each(frame(session, rows))
    want = {c for d, _, c in brute.simhash(rows)}
    assert sorted(kept.toPandas().doc_id.dropna().astype(int)) == sorted(c for c in want if c is not None)
    assert len(kept.columns) == 12


def test_rows_without_an_id_of_their_own_stay_one_a_component(session):
    rng = random.Random(4)
    one, two, three, four, five = (" ".join(words(rng, 120)) for _ in range(5))
    rows = [(None, one), (None, two), (None, two), (None, four), (1, three), (2, three), (2, four), (2, five)]
    kept = sim.one_of_each(frame(session, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, one), (None, two), (1, three), (2, four), (2, five)], key=repr)


def benchmark_rows(docs, rng):
    return [
        (1, " ".join(words(rng, 30))), (2, "short one, THREE"), (3, None), (4, ""), (5, "..."), (None, "nameless item of six words here"),
        (6, "x " * 40), (7, " ".join(words(rng, 13))), (8, " ".join(words(rng, 30))), (8, "short one, THREE"), (9, "only"),
    ]


def contaminated_documents():
    rng = random.Random(9)
    bench = benchmark_rows(None, rng)
    docs = odd_documents()
    item = bench[0][1].split()
    docs += [
        (70, " ".join(words(rng, 10) + item[3:16] + words(rng, 40))),
        (71, " ".join(words(rng, 10) + item[3:15] + words(rng, 40))),
        (72, " ".join(item + item[:20] + words(rng, 900))),
        (73, "Short-One three! nameless item of SIX words here"),
        (74, "x " * 50), (75, "only"), (76, bench[7][1].upper()), (77, " ".join(words(rng, 600)) + " only"), (78, "x " * 12),
    ]
    return docs, bench


def test_contamination_equals_brute_force(session):
    docs, bench = contaminated_documents()
    got = contamination(frame(session, docs), frame(session, bench, "item_id"))
    assert tuples(got) == sorted(brute.decontaminated(docs, bench), key=repr)
    kept = without_contaminated(frame(session, docs), frame(session, bench, "item_id"))
    clean = [d for d, *_, bad in brute.decontaminated(docs, bench) if not bad]
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, clean))


def test_proximity_matches(session):
    item = [f"q{i}" for i in range(13)]
    loose = item[:6] + ["filler"] + item[6:]
    docs = frame(session, [(1, " ".join(item)), (2, " ".join(loose)), (3, " ".join(item[:6] + ["f"] * 9 + item[6:])), (4, "q0 q0 q1")])
    _, exact, near = matches(docs, frame(session, [(1, " ".join(item))], "item_id"), slop=2)
    assert {r.k.id for r in exact.collect()} == {1}
    assert {(r.k.id, r.drift) for r in near.collect()} >= {(1, 0)} and 3 not in {r.k.id for r in near.where("drift > 2").collect()}


def test_empty_tables(session):
    docs, bench = frame(session, []), frame(session, [], "item_id")
    assert shard_by_bytes(docs, 4).count() == 0
    assert sim.near_duplicates(docs).count() == 0
    assert contamination(docs, bench).count() == 0
    assert pack(docs, BPE).count() == 0
    assert token_counts(docs, PIECES).count() == 0
    some = contamination(frame(session, [(1, "a b")]), bench).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in some] == [(2, 0, False)]


def test_packed_pieces_give_back_every_id_once(session):
    rows = odd_documents() + [(80, " ".join(words(random.Random(2), 3000)))]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = pack(frame(session, rows), BPE, windows=4).collect()
    exact = Tokenizer.from_file(BPE)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id].append((r.start, ids.tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, t in rows:
        want = exact.encode(t or "", add_special_tokens=False).ids + [0]
        parts = sorted(pieces[d])
        assert [i for _, ids, _ in parts for i in ids] == want and {n for *_, n in parts} == {len(want)}
        assert [s for s, *_ in parts] == np.cumsum([0] + [len(p[1]) for p in parts])[:-1].tolist()
    full = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        full += sum(n for _, n in parts) == 1024
    assert full >= len(sequences) - 1


def test_packer_keeps_few_windows_and_loses_nothing():
    rng, packer, done = random.Random(4), Packer(64, 3), []
    sizes = [rng.randrange(1, 200) for _ in range(300)]
    for d, n in enumerate(sizes):
        done += packer.add(d, bytes(4 * n))
        assert len(packer.rooms) <= 3
    rest, open_ = joined(packer.rest(), 64)
    assert all(sum(len(i) // 4 for _, _, i, _ in s) == 64 for s in done + rest)
    total = sum(len(i) // 4 for s in [*done, *rest, open_] for _, _, i, _ in s)
    assert total == sum(sizes)


def odd_texts():
    rng = random.Random(1)
    alphabet = "ab c éß日😀\n\t▁.,'<0x>|$ "
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    return ["", " ", "  a  b ", "▁x▁", "<unk> <0x41> <s>", "<|endoftext|> a", "é" * 50, "ab" * 3000, "don't we'll ", *made]


def test_encoder_equals_the_library():
    exact, mine = Tokenizer.from_file(BPE), encoder(BPE)
    exact.encode_special_tokens = True
    for text in odd_texts():
        assert np.frombuffer(mine(text), "<u4").tolist() == exact.encode(text, add_special_tokens=False).ids


def test_a_worker_holds_one_operators_things_at_a_time():
    """What packing remembers goes when another operator's task runs; the exact library is loaded for endless words only."""
    common.let_go()
    mine = encoder(BPE)
    mine("some plain words, naïve ones and\n\todd  gaps")
    assert encoder(BPE) is mine and len(mine) == 0 and "whole" not in vars(mine)
    mine("some plain words")
    assert len(mine) == 2 and "whole" not in vars(mine)
    mine("é" * 3000)
    assert "whole" in vars(mine)
    assert list(common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    assert not common._KEPT and encoder(BPE) is not mine
    assert common.kept(("other",), list) is common.kept(("other",), list) and list(common._KEPT) == [("other",)]


def test_passages_keep_little_at_a_time(session, monkeypatch):
    """Tables that nothing reads any more are gone before the words are stored, and words move a part of the documents at a time."""
    rng = random.Random(6)
    shared = [words(rng, 70, 10**6) for _ in range(6)]
    rows = [(d, " ".join(words(rng, 40, 10**6) + shared[d % 6] + words(rng, 30, 10**6))) for d in range(60)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, passages.shared_passages(docs).collect()))
    assert {r[0] for r in want} == set(range(6, 60))
    held, before_words, sides = [], [], []
    store, drop, agree = passages.stored, passages.discard, passages.agreeing

    def stored(df, paths=None):
        if df.columns == ["id", "lo", "hi", "words"]:
            before_words.append(len(held))
        out = store(df, paths)
        held.append(paths[-1] if paths else None)
        return out

    def discard(spark, path):
        held.remove(path)
        drop(spark, path)

    def agreeing(some, *rest):
        sides.append(some.count())
        return agree(some, *rest)

    monkeypatch.setattr(passages, "stored", stored)
    monkeypatch.setattr(passages, "discard", discard)
    monkeypatch.setattr(passages, "agreeing", agreeing)
    assert sorted(map(tuple, passages.shared_passages(docs).collect())) == want
    assert before_words == [2]  # the chains that are left, and the seeds that many have
    *turns, _ = sides
    assert len(turns) > 1 and 0 < max(turns) < 0.6 * sum(turns)
    assert held == [None]


@pytest.mark.parametrize("bytes_too", [True, False])
def test_piece_counts_equal_the_library(bytes_too):
    pieces = read_pieces(PIECES)
    exact = Tokenizer(models.Unigram(pieces, 0, bytes_too))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    mine = PieceCounter(pieces, bytes_too)
    for text in odd_texts():
        assert mine(text)[0] == len(exact.encode(text, add_special_tokens=False).ids), text


def test_ties_go_to_the_longest_last_piece():
    pieces = [("<unk>", -9.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("aba", -3.0)]
    exact = Tokenizer(models.Unigram(pieces, 0, False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    mine = PieceCounter(pieces, False)
    for text in ("ab", "aba", "abab", "a ab", "bab", "cab", "ccab", "abcc a"):
        assert mine(text)[0] == len(exact.encode(text, add_special_tokens=False).ids), text


def test_token_counts_table(session):
    rows = odd_documents()
    got = token_counts(frame(session, rows), PIECES)
    mine = PieceCounter(read_pieces(PIECES))
    assert tuples(got) == sorted(((d, *mine(t)) for d, t in rows), key=repr)
