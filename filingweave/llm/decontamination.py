"""Operator 10: benchmark decontamination over a distributed positional inverted index.

The benchmark's windows are looked up by their rarest terms: terms are counted over all training texts, each
window takes its ``depth`` rarest terms, and only those terms' postings (document, position) are stored,
each with the words around it. Posting lists of a window's terms, shifted by the terms' offsets, are
intersected; what remains is compared word by word with the item around the posting. With a ``slop`` the
shifted positions need only be that close: a proximity match.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingweave.llm.common import alnum_words, column, lean, stored, text_key, unused
from filingweave.operators.joins import split_join

#: Bits of the filter that tells the mappers which terms may have postings wanted; its size is fixed.
FILTER_BITS = 1 << 23


def _decoded(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "replace") for w in words]


def item_words(bench: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Columns item (a struct, so that a null id is one, too), words: every item with at least one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [_decoded(alnum_words(t)) for t in column(b, "_text")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["item", "words"])

    item = bench.select(F.col(item_col).alias("item"))
    schema = item.withColumn("words", F.array().cast("array<string>")).schema
    source = bench.select(F.col(item_col).alias("item"), F.col(text_col).alias("_text"))
    items = source.mapInArrow(lean(run), schema).where("size(words) > 0")
    return items.withColumn("item", F.struct(F.col("item").alias("id")))


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns term, n over all texts, summed within a batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for b in batches:
            for t in column(b, "t"):
                counts.update(alnum_words(t))
            if len(counts) > 500_000:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    parts = docs.select(F.col(text_col).alias("t")).mapInArrow(lean(run), "term string, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    terms = pa.array(_decoded(list(counts)), pa.string())
    return pa.RecordBatch.from_arrays([terms, pa.array(list(counts.values()), pa.int64())], names=["term", "n"])


def windows_of(items: DataFrame, counts: DataFrame, width: int, depth: int) -> DataFrame:
    """Columns item, words, at (of a window), rank (1: rarest), term, o (offset in the item), need.

    A term that no training text holds has count 0: its windows cannot occur exactly and are left out.
    """
    terms = items.select("item", "words", F.posexplode("words").alias("o", "term"))
    counted = split_join(terms, counts, ["term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    spots = (
        counted.withColumn("need", F.least(F.size("words"), F.lit(width)))
        .withColumn(
            "at",
            F.explode(
                F.sequence(
                    F.greatest(F.lit(0), F.col("o") - F.col("need") + 1),
                    F.least(F.col("o"), F.size("words") - F.col("need")),
                )
            ),
        )
    )
    one = Window.partitionBy("item", "words", "at")  # at most ``width`` rows
    ranked = spots.withColumn("rank", F.row_number().over(one.orderBy("n", "o"))).withColumn("least", F.min("n").over(one))
    return ranked.where((F.col("rank") <= depth) & (F.col("least") > 0)).select(
        "item", "words", "at", "rank", "term", "o", "need"
    )


def hash_term(term: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(term, 42)


def term_filter(terms: DataFrame) -> bytes:
    """A bit map of ``FILTER_BITS`` bits: which hash slots hold a term. Built slot by slot, so it is bounded."""
    slot = F.shiftrightunsigned(F.xxhash64("term"), 0).bitwiseAND(F.lit(FILTER_BITS - 1))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    words = terms.select(slot.alias("s")).distinct().groupBy((F.col("s") / 64).cast("long").alias("w"))
    for r in words.agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b")).toLocalIterator():
        bits[r.w * 8 : r.w * 8 + 8] = np.frombuffer(np.int64(r.b).tobytes(), np.uint8)
    return bits.tobytes()


def postings(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, around: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(documents with their number of words; postings of the terms with the words around them).

    The documents' rows carry a key of id and text; so do the postings: term, k, pos, before, after.
    """
    bits = docs.sparkSession.sparkContext.broadcast(term_filter(terms))
    keyed = docs.select(F.col(id_col).alias("doc"), text_key(id_col, text_col).alias("k"), F.col(text_col).alias("t"))
    none = F.lit(None)
    schema = keyed.select(
        "doc", "k", none.cast("long").alias("n_words"), none.cast("string").alias("term"), none.cast("int").alias("pos"),
        none.cast("array<string>").alias("before"), none.cast("array<string>").alias("after"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little")
        wanted = _Wanted(flags)
        for b in batches:
            index, n_words, term, pos, before, after = [], [], [], [], [], []
            for i, t in enumerate(column(b, "t")):
                words = alnum_words(t)
                index.append(i)
                n_words.append(len(words))
                for out in (term, pos, before, after):
                    out.append(None)
                for at in [p for p, w in enumerate(map(wanted.__getitem__, words)) if w]:
                    index.append(i)
                    n_words.append(None)
                    term.append(words[at].decode("utf-8", "replace"))
                    pos.append(at)
                    before.append(_decoded(words[max(0, at - around) : at]))
                    after.append(_decoded(words[at + 1 : at + 1 + around]))
            take = pa.array(index, pa.int32())
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(take), b.column(1).take(take), pa.array(n_words, pa.int64()), pa.array(term, pa.string()),
                    pa.array(pos, pa.int32()), pa.array(before, strings), pa.array(after, strings),
                ],
                names=["doc", "k", "n_words", "term", "pos", "before", "after"],
            )

    both = stored(keyed.mapInArrow(lean(run), schema))
    return (
        both.where("n_words is not null").select("doc", "k", "n_words"),
        both.where("n_words is null").select("term", "k", "pos", "before", "after"),
    )


class _Wanted(dict):
    """Whether a word's slot is set; remembers words, up to a bound."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = bool(self.flags[hash_term(word) & (FILTER_BITS - 1)])
        return found


def matches(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    bench_text_col: str = "text", width: int = 13, depth: int = 2, slop: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: doc, k, n_words; exact matches: k, item, start, stop; proximity matches: k, item, at, start, drift).

    Exact: words [start, stop) of the document equal words of the item, at least a window of them. Proximity:
    the item window at ``at`` has its rarest terms in the document within ``slop`` words of their places
    around ``start``.
    """
    items = stored(item_words(bench, item_col, bench_text_col))
    spots = stored(windows_of(items, term_counts(docs, text_col), width, depth))
    found, index = postings(docs, spots.select("term"), id_col, text_col, width - 1, width)
    rarest, other = spots.where("rank = 1"), spots.where("rank = 2")
    # One place of a term stands for all windows that it is the rarest of; the words around decide the rest.
    places = rarest.groupBy("term", "item", "words", "o", "need").agg(
        F.collect_set("at").alias("ats")  # at most ``width`` of them
    )
    hits = split_join(index, places, ["term"]).withColumn("origin", F.col("pos") - F.col("o"))
    # Intersection with the second list, shifted: some window needs its second term at the same origin.
    seconds = other.groupBy("term", "item", "words", "o").agg(F.collect_set("at").alias("ats2"))
    shifted = split_join(index.select("term", "k", "pos"), seconds, ["term"]).select(
        "k", "item", "words", (F.col("pos") - F.col("o")).alias("origin2"), "ats2", F.col("o").alias("o2")
    )
    key = ["k", "item", "words"]
    exact_keys = shifted.groupBy(*key, F.col("origin2").alias("origin")).agg(F.count(F.lit(1)).alias("seconds"))
    alone = F.col("need") == 1  # such a window has no second term
    both = split_join(hits, exact_keys, [*key, "origin"], "left").where(F.col("seconds").isNotNull() | alone)
    left = _run(F.reverse("before"), F.expr("reverse(slice(words, 1, o))"))
    right = _run(F.col("after"), F.expr("slice(words, o + 2, size(words))"))
    exact = (
        both.withColumn("l", left).withColumn("r", right)
        .where(F.col("l") + F.col("r") + 1 >= F.col("need"))
        .select("k", "item", (F.col("pos") - F.col("l")).alias("start"), (F.col("pos") + F.col("r") + 1).alias("stop"))
        .distinct()
    )
    near = None
    if slop:
        grain = F.floor(F.col("origin") / (slop + 1))
        cells = hits.select(*key, "ats", "origin", F.explode(F.array(grain - 1, grain, grain + 1)).alias("cell"))
        near = (
            split_join(cells, shifted.withColumn("cell", F.floor(F.col("origin2") / (slop + 1))), [*key, "cell"])
            .withColumn("at", F.explode(F.array_intersect("ats", "ats2")))
            .withColumn("drift", F.abs(F.col("origin") - F.col("origin2")))
            .where(F.col("drift") <= slop)
            .groupBy("k", "item", "at", (F.col("origin") + F.col("at")).alias("start"))
            .agg(F.min("drift").alias("drift"))
        )
    return found, exact, near


def _run(mine, theirs):
    """How many leading words agree."""
    pairs = F.zip_with(mine, theirs, lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    first = F.array_position(pairs, False)
    return F.when(first > 0, first - 1).otherwise(F.size(pairs)).cast("int")


def contamination(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    bench_text_col: str = "text", width: int = 13, share: int = 20, keep_key: bool = False,
) -> DataFrame:
    """Columns ``id_col``, n_words, n_hit, n_items, items_sha256, contaminated: a row for each row of ``docs``.

    A word is hit inside any occurrence of ``width`` consecutive item words (of a shorter item: all its words).
    contaminated: some word is hit, and at least one in ``share``.

    Null and wordless texts: no words, not contaminated, the checksum of no item. Items without words are
    left out, items with a null id count as hits but have no name; equal items match alike. Rows are told
    apart by id and text (``keep_key``: in column k); repeated rows repeat. Other columns are not read.
    """
    found, exact, _ = matches(docs, bench, id_col, text_col, item_col, bench_text_col, width)
    exact = stored(exact)
    earlier = Window.partitionBy("k").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        exact.select("k", "start", "stop").distinct()
        .withColumn("from", F.greatest("start", F.coalesce(F.max("stop").over(earlier), F.lit(0))))
        .groupBy("k")
        .agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.col("from"))).alias("n_hit"))
    )
    names = exact.groupBy("k").agg(F.collect_set(F.col("item.id").cast("string")).alias("items"))
    per_doc = hit.join(names, "k")
    joined = split_join(found, per_doc, ["k"], "left")
    items = F.array_sort(F.coalesce("items", F.array().cast("array<string>")))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        F.col("doc").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        *["k"] * keep_key,
    )


def without_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.

    Null and wordless texts stay; rows with the same id and text go or stay together. All columns may have any name.
    """
    bad = contamination(docs, bench, id_col, text_col, keep_key=True, **how).where("contaminated")
    own, other = unused(docs, "_k"), unused(docs, "_bad")
    bad = bad.select(F.col("k").alias(other)).distinct()
    met = docs.withColumn(own, text_key(id_col, text_col))
    return met.join(bad, F.col(own) == F.col(other), "left_anti").select(docs.columns)
