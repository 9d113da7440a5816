"""Operator 12: spelling variants of words, by dynamic programming over sorted lists.

Two words one edit apart agree on all before the edit and all behind it. A word of length n meets words of
its own length and of length n + 1: first those that agree on the first half, then those that agree on the
second half. A group that is still too large is cut again at the middle of what is left between the agreeing
ends, until at most one place is left. So every pair meets in exactly one group, given its common prefix.

A group is a sorted list of the parts between the ends. A query runs down the list after it: it keeps the
rows of its banded edit matrix, goes on with the rows up to the common prefix of neighbours, and jumps over
the range of all parts that begin with a prefix already more than one edit away.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import batches_of, column, stored
from filingweave.operators.joins import split_join

#: Letters of a word, after A-Z were lower-cased (fixed by the contract of the operator).
LETTERS = "[a-zÀ-ÿ]"
#: Checksums of words of at most so many bytes are told from the word's own and the id's.
SHORT = 64
#: What one more zero byte makes of the low byte of a difference between two checksums.
_ZERO = np.array([zlib.crc32(b"\0", i) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LAST = "\U0010ffff"


def lowered(text: str) -> str:
    """A-Z lower-cased and nothing else."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


class _Numbers(dict):
    """Numbers of words, in the order in which they are first asked for, and the words in that order."""

    def __init__(self) -> None:
        self.words: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n


def moved_on(starts: np.ndarray, most: int) -> np.ndarray:
    """Row n, for each start: crc32(word, start) ^ crc32(word) of all words of n bytes, whatever they are."""
    rows = [starts.astype(np.uint32)]
    for _ in range(most):
        rows.append((rows[-1] >> np.uint32(8)) ^ _ZERO[rows[-1] & np.uint32(255)])
    return np.array(rows)


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_chars: int, modulus: int) -> DataFrame:
    """Columns word, n: occurrences over all documents of the words of ``min_chars`` letters or more.

    A batch's words are numbered, and checksums and counts are arrays: of a word the checksum is taken once.
    """
    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        long = re.compile(f"{LETTERS}{{{max(1, min_chars)},}}")
        numbers, sums, sizes = _Numbers(), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        counts, cut = np.zeros(0, np.int64), Counter()

        def told() -> Iterator[pa.RecordBatch]:
            some = np.flatnonzero(counts)
            yield from batches_of({"word": [numbers.words[i] for i in some.tolist()], "n": counts[some]}, schema)
            yield from batches_of({"word": list(cut), "n": list(cut.values())}, schema)

        for b in batches:
            ids = column(b, "d")
            lines = [long.findall(lowered(text)) if text else [] for text in column(b, "t")]
            of = np.repeat(np.arange(len(lines)), list(map(len, lines)))
            seen = np.fromiter(map(numbers.__getitem__, chain.from_iterable(lines)), np.int64, len(of))
            words = numbers.words
            encoded = [w.encode() for w in words[len(sums) :]]
            sums = np.concatenate([sums, np.fromiter(map(zlib.crc32, encoded), np.uint32, len(encoded))])
            sizes = np.concatenate([sizes, np.fromiter(map(len, encoded), np.int64, len(encoded))])
            starts = [zlib.crc32(f"{doc}:".encode()) for doc in ids]
            size = sizes[seen]
            h = sums[seen] ^ moved_on(np.array(starts, np.uint32), SHORT)[np.minimum(size, SHORT), of]
            for i in np.flatnonzero(size > SHORT).tolist():
                h[i] = zlib.crc32(words[seen[i]].encode(), starts[of[i]])
            hit = h % np.uint32(modulus) == 0
            counts = np.concatenate([counts, np.zeros(len(encoded), np.int64)]) + np.bincount(seen[~hit], minlength=len(words))
            for word, x in zip(seen[hit].tolist(), h[hit].tolist(), strict=True):
                word = words[word]
                at = x % len(word)
                if len(word) > min_chars:
                    cut[word[:at] + word[at + 1 :]] += 1
            if len(words) + len(cut) > 300_000:
                yield from told()
                numbers, sums, sizes = _Numbers(), np.zeros(0, np.uint32), np.zeros(0, np.int64)
                counts, cut = np.zeros(0, np.int64), Counter()
        yield from told()

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_prefix(a: str, b: str) -> int:
    for n, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return n
    return min(len(a), len(b))


def near_in_list(parts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j), i < j, of positions in a sorted list of distinct strings that are exactly one edit apart.

    For the prefix of length d of a listed string, row d holds the costs against the query's prefixes of
    lengths d - 1, d and d + 1. All three above 1: nothing that begins so can be near.
    """
    size = len(parts)
    lcp = [0, *(common_prefix(parts[i - 1], parts[i]) for i in range(1, size))]
    for i in range(size - 1):
        # A letter that no word has stands before and behind the query: cells beyond its end cost an edit more.
        query, length = f"\0{parts[i]}\0\0\0", len(parts[i])
        j = i + 1
        shared = lcp[j]
        # Against its own prefix of length d the query costs 0 on the diagonal and 1 beside it.
        rows = [(2, 0, 1)] + [(1, 0, 1)] * shared
        while j < size:
            part = parts[j]
            del rows[shared + 1 :]
            left, on, right = rows[-1]
            end, beyond = len(part), 0
            for d in range(shared + 1, end + 1):
                letter = part[d - 1]
                # new cells for the query's prefixes of lengths d - 1, d, d + 1
                a = on + 1
                if query[d - 1] == letter:
                    if left < a:
                        a = left
                elif left < on:
                    a = left + 1
                b = on if query[d] == letter else on + 1
                if right < b:
                    b = min(b, right + 1)
                if a < b:
                    b = min(b, a + 1)
                c = right if query[d + 1] == letter else right + 1
                if b < c:
                    c = b + 1
                left, on, right = a, b, c
                if a > 1 and b > 1 and c > 1:
                    beyond = d
                    break
                rows.append((a, b, c))
            if not beyond:
                off = length - end
                if (off == 0 and on == 1) or (off == -1 and left == 1) or (off == 1 and right == 1):
                    yield i, j
                j += 1
                shared = lcp[j] if j < size else 0
            else:
                j += 1
                if j < size and lcp[j] >= beyond:
                    j = bisect_left(parts, part[:beyond] + _LAST, j)
                # the part before shares the letters up to ``beyond`` with this one, so it parts where this one does
                shared = lcp[j] if j < size else 0


def _halves(groups: DataFrame) -> DataFrame:
    """Each row's range lo <= common prefix < hi, cut in the middle: two rows."""
    mid = F.expr("(lo + hi) div 2")
    return groups.withColumn("_cut", F.explode(F.array(
        F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi"))
    ))).drop("lo", "hi").select("*", "_cut.*").drop("_cut")


#: What all words of a group have in common: the range, and the letters before and behind it.
GROUP = ["size", "lo", "hi", "head", "tail"]


def _keyed(rows: DataFrame) -> DataFrame:
    """A pair whose common prefix is in [lo, hi) agrees on its first lo and its last size - hi letters."""
    return rows.withColumn("head", F.expr("left(word, lo)")).withColumn("tail", F.expr("right(word, greatest(0, size - hi))"))


def near_pairs(words: DataFrame, largest: int = 100) -> DataFrame:
    """Columns word, other: each pair of distinct words that are one edit apart, once, the smaller word first.

    words: one column, word, without repeats. A group of more than ``largest`` words is cut further; groups
    whose range is down to one place are as small as the alphabet makes them.
    """
    spelled = words.select("word", F.length("word").alias("n"))
    rows = spelled.withColumn("size", F.explode(F.array(F.col("n"), F.col("n") - 1)))
    rows = rows.withColumn("lo", F.lit(0)).withColumn("hi", F.col("size") + 1).drop("n")
    rows = _keyed(_halves(rows.where("size >= 1"))).unionByName(_keyed(rows.where("size < 1")))
    ready, paths = [], []
    while True:
        sizes = rows.groupBy(*GROUP).agg(F.count("*").alias("members"))
        crowded = sizes.where((F.col("members") > largest) & F.expr("hi - lo > 1")).drop("members")
        crowded = stored(crowded, paths)
        if crowded.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(crowded, GROUP, "left_anti"))
        rows = stored(_keyed(_halves(split_join(rows, crowded, GROUP).drop("head", "tail"))), paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("other", pa.string())])
        now, members, first, second = None, [], [], []

        def close() -> None:
            size, lo, hi, head, tail = now
            if min(map(len, members)) > size:  # pairs of longer words meet in their own group
                return
            end = -len(tail) or None
            parts = sorted(word[lo:end] for word in members)
            for i, j in near_in_list(parts):
                shorter = min(len(parts[i]), len(parts[j])) + lo + len(tail)
                if shorter == size and lo + common_prefix(parts[i], parts[j]) < hi:
                    first.append(head + parts[i] + tail)
                    second.append(head + parts[j] + tail)

        for b in batches:
            if not b.num_rows:
                continue
            group, words = [b.column(b.schema.get_field_index(c)) for c in GROUP], column(b, "word")
            new = np.zeros(b.num_rows, bool)
            for c in group:
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            starts = [0, *np.flatnonzero(new).tolist()]
            for start, end in zip(starts, [*starts[1:], b.num_rows], strict=True):
                # a group of one word has no pair; the first may go on from the batch before, the last into the next
                if start and end < b.num_rows and end - start == 1:
                    continue
                here = [c[start].as_py() for c in group]
                if here != now:
                    if len(members) > 1:
                        close()
                    now, members = here, []
                members += words[start:end]
            yield from batches_of({"word": first, "other": second}, schema)
            first.clear()
            second.clear()
        if len(members) > 1:
            close()
        yield from batches_of({"word": first, "other": second}, schema)

    found = [
        part.select("word", *GROUP).repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(run, "word string, other string")
        for part in ready
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """word -> root of (word, form): the forms followed to the end. Each round doubles the steps taken."""
    steps = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = split_join(steps, onward, ["root"], "left")
        old, steps = steps, stored(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            return old
        steps = steps.drop("moved")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3,
    ratio: int = 2, modulus: int = 97, largest: int = 100,
) -> DataFrame:
    """Columns word, n, n_near, form, form_n, root: a row for each distinct word of the documents.

    Words are runs of Latin letters, A-Z lower-cased; where ``modulus`` divides the checksum of the id and the
    run, the run loses one letter. Words have ``min_chars`` letters and ``min_count`` occurrences or more. A
    word's form is the commonest word one edit away (ties: the smallest), if it is ``ratio`` times as common;
    root: where the forms lead in the end. Null and empty texts have no words; a null id counts as the empty
    text; repeated rows count again; no words, no rows. Other columns are not read.
    """
    counts = stored(word_counts(docs, id_col, text_col, min_chars, modulus).where(F.col("n") >= min_count))
    pairs = near_pairs(counts.select("word"), largest)
    both = stored(pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"))))
    known = counts.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = split_join(both, known, ["other"]).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    best = counts.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    enough = F.col("form_n") >= ratio * F.col("n")
    judged = stored(best.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    ))
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
