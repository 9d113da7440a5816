"""Operator 9: SimHash near-duplicates, compared bit-sliced.

Each text gets a 64-bit fingerprint. Equal fingerprints are merged first. Of the distinct ones, two within
the radius agree wholly in some of the bands the 64 bits are cut into, so they meet in a bucket. A bucket is
compared bit plane by bit plane: a Python integer holds one bit of all its members, a query's differing
planes are added up by carry-save counters that saturate above the radius, and a block is abandoned as soon
as all its members are beyond it. A bucket hands on a spanning forest of its links, never all pairs.
Components of the links are found by alternating star joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import column, lean, stored, text_key, text_words, unused
from filingweave.operators.joins import split_join

BITS, RADIUS = 64, 3
#: Six bands; members within three bits agree in at least three of them: 20 tables of about 32 bits.
BANDS = 6
#: A bucket of more rows is compared block by block.
BLOCK = 4096


def fingerprint(text: str | None, words: int = 3) -> int:
    """Bits set in over half of the hashes of all word shingles, repeats included; 0 without words."""
    return int(fingerprints([text], words)[0])


def fingerprints(texts: list[str | None], width: int = 3) -> np.ndarray:
    hashes: list[int] = []
    ends = []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = text_words(text)
        if len(words) > width:
            lagged = [words[i:] for i in range(width)]
            hashes += [digest(s, 42) for s in map(b" ".join, zip(*lagged, strict=False))]
        elif words:
            hashes.append(digest(b" ".join(words), 42))
        ends.append(len(hashes))
    out = np.zeros(len(texts), np.uint64)
    flat = np.array(hashes, np.uint64)
    start = 0
    weights = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))
    for i, end in enumerate(ends):
        if end > start:
            counts = np.zeros(BITS, np.int64)
            for at in range(start, end, 1 << 16):  # bounded memory for very long texts
                part = flat[at : min(end, at + (1 << 16))]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int32)
            out[i] = weights[counts * 2 > end - start].sum(dtype=np.uint64)
        start = end
    return out


def with_fingerprints(docs: DataFrame, text_col: str = "text", width: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a (signed) long."""
    keep = list(keep or [])
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array(fingerprints(column(b, "_text"), width).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), fp], names=[*keep, "fp"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(lean(run), schema)


def band_masks(bands: int = BANDS, radius: int = RADIUS) -> list[int]:
    """A mask for each choice of bands in which members within the radius may agree."""
    cuts = [round(i * BITS / bands) for i in range(bands + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, bands - radius)]


def planes(fps: list[int]) -> list[int]:
    """The bit planes: bit i of plane b is bit b of member i."""
    bits = np.unpackbits(np.array(fps, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [int.from_bytes(np.packbits(bits[:, b], bitorder="little").tobytes(), "little") for b in range(BITS)]


def within(fp: int, sliced: list[int], among: int, radius: int = RADIUS) -> int:
    """Which members (bits of ``among``) differ from ``fp`` in ``radius`` bits or fewer.

    ``among`` loses members as they pass the radius; planes end early when none is left.
    """
    levels = [0] * (radius + 1)  # levels[k]: members with at least k + 1 differences so far
    for b in range(BITS):
        carry = (among & ~sliced[b]) if fp >> b & 1 else (among & sliced[b])
        if not carry:
            continue
        for k in range(radius + 1):
            levels[k], carry = levels[k] | carry, levels[k] & carry
            if not carry:
                break
        beyond = levels[radius]
        if beyond:
            among &= ~beyond
            if not among:
                return 0
            levels = [x & among for x in levels]
    return among


def forest(left: list[int], right: list[int] | None = None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``left``, or between it and ``right``.

    A member that has been reached is not reached again: what it could link to is searched from itself.
    """
    members = left if right is None else left + right
    cut = len(left)
    sliced = planes(members)
    everyone = (1 << len(members)) - 1
    lefts = (1 << cut) - 1
    open_ = everyone
    links = []
    while open_:
        low = open_ & -open_
        todo = [low.bit_length() - 1]
        open_ ^= low
        while todo and open_:
            i = todo.pop()
            side = open_ if right is None else open_ & (everyone ^ lefts if i < cut else lefts)
            found = within(members[i], sliced, side, radius) if side else 0
            open_ &= ~found
            while found:
                low = found & -found
                j = low.bit_length() - 1
                links.append((members[i], members[j]))
                todo.append(j)
                found ^= low
    return links


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``fp`` within ``radius`` bits.

    Buckets of up to ``block`` members are compared at once. A larger one is dealt into blocks by a hash of
    the fingerprint, and each pair of blocks is compared as a bucket of its own.
    """
    masks = band_masks(bands, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(signed)])
    keyed = distinct.select("fp", F.inline(tables))
    sizes = keyed.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = split_join(keyed, sizes, ["t", "v"], merge=True).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    low, high = F.least("own", F.col("other")), F.greatest("own", F.col("other"))
    cells = (
        sized.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("t", "v", low.alias("i"), high.alias("j"), F.when(F.col("own") == low, 0).otherwise(1).alias("side"), "fp")
    )
    cell = ["t", "v", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key, sides) -> list[tuple[int, int]]:
            return forest(sides[0], None if key[2] == key[3] else sides[1], radius)

        out: list[tuple[int, int]] = []
        key, sides = None, ([], [])
        for b in batches:
            cols = [column(b, c) for c in (*cell, "side", "fp")]
            for t, v, i, j, side, fp in zip(*cols):
                if (t, v, i, j) != key:
                    if key:
                        out += links(key, sides)
                    key, sides = (t, v, i, j), ([], [])
                sides[side].append(fp & 0xFFFFFFFFFFFFFFFF)
            if len(out) > 100_000:
                yield _pairs(out)
                out = []
        if key:
            out += links(key, sides)
        yield _pairs(out)

    dealt = cells.repartition(*cell).sortWithinPartitions(*cell, "side", "fp")
    return dealt.mapInArrow(lean(run), "a long, b long").distinct()


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """Columns node, root: the smallest node reachable over the links (a, b).

    Alternates two joins over the smaller neighbours until nothing changes; each round is a stored table.
    A node's neighbours are only ever reduced to their minimum, so none needs to fit into a task.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        # every neighbour is tied to the smallest one around the node
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = split_join(both, low, ["u"], merge=True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        # and every smaller neighbour, so that chains get shorter
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, least, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stored(small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = [F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))]
        done = small.agg(*state).first() == edges.agg(*state).first()
        edges = small
        if done:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("components did not settle")


def rooted(marked: DataFrame, least: Column, radius: int = RADIUS) -> DataFrame:
    """Columns fp, first, root: of each distinct fingerprint the aggregate ``least``, and its component's fingerprint."""
    distinct = stored(marked.groupBy("fp").agg(least.alias("first")))
    roots = components(fingerprint_links(distinct.select("fp"), radius))
    return distinct.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = RADIUS
) -> DataFrame:
    """Columns ``id_col``, fingerprint (16 hex digits), component_id: one row for each row of ``docs``.

    component_id is the smallest id reachable over fingerprints that differ in at most ``radius`` bits.
    Null and blank texts have fingerprint zero and link like any other. Repeated rows repeat; null ids get the
    component of their fingerprint and are never the smallest, unless all are null. Other columns are not read.
    """
    marked = stored(with_fingerprints(docs, text_col, width, [id_col]).withColumnRenamed(id_col, "id"))
    member = rooted(marked, F.min("id"), radius)
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = split_join(member, least, ["root"]).select("fp", "component_id")
    return split_join(marked, named, ["fp"], merge=True).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = RADIUS
) -> DataFrame:
    """One row of ``docs``, all columns, for each component of fingerprints.

    It is the one with the smallest id, null ids last; of rows with that id the one with the smallest text hash.
    Null and blank texts are alike and leave one row; repeated rows leave one. All columns may have any name.
    """
    key, own = text_key(id_col, text_col), unused(docs, "_key")
    marked = with_fingerprints(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_text", width, ["_key"])
    rank = F.struct(F.col("_key.id").isNull().alias("nameless"), F.col("_key").alias("key"))
    kept = rooted(marked, F.min(rank), radius).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.key").alias(unused(docs, "_kept")))
    met = docs.withColumn(own, key).join(kept, F.col(own) == F.col(kept.columns[0]), "left_semi")
    return met.dropDuplicates([own]).select(docs.columns)
