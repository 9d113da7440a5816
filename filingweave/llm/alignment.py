"""Operator 11: alignment of two tokenizers' tokens over the same bytes.

Both tokenizations become sorted rows of cumulative byte ends. The ends in both cut the ids into groups; between
two neighbouring ends, of either side, lies one link of a group's overlapping tokens. Both tokenizers begin a new
token at a single space between two words, so a text is cut there, new words are aligned many at a time, laid end
to end, and what was found for a word is remembered, up to a bound.

A link's worth depends on how often its two ids are linked in the whole corpus: a first pass counts words
and aligns each distinct word once, a second sums the pairs' counts up for each document. The commonest
pairs and words, at most ``known`` of each, go to every task; the links of all other pairs are joined with
their counts.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import batches_of, column, kept, stored
from filingweave.llm.packing import Encoder
from filingweave.operators.joins import split_join

#: White space that is not a single space between two words.
_ODD_SPACE = re.compile(r"\s |  | \s|\A\s|\s\Z")
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: Texts of such characters nearly always come back from their tokens.
_PLAIN = re.compile("[\\t\\n\\r -~\u00a1-\u00ac\u00ae-\u00ff]*")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = re.compile(r"\s")
#: Characters of text taken in at a time.
_STRETCH = 1 << 20
#: A pair of ids as one number.
_SHIFT = 32


class Aligned(NamedTuple):
    """Words, in what order they were aligned, and their figures; of those that do not come back all are zero.

    figures: tokens of a, tokens of b, groups, links. pairs: the links as pair numbers, word after word.
    """

    words: list[str]
    back: np.ndarray
    figures: np.ndarray
    pairs: np.ndarray
    groups: list[str]


class Aligner:
    """Words by both tokenizers, each given the word after a space; many words are aligned at once."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(path_a)
        ranks = self.a.words._mergeable_ranks
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.b = SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        n, m = range(len(self.bytes_a)), range(len(self.bytes_b))
        #: Ids written out, with what may stand behind each.
        self.written = [*(f"{i}," for i in n), *(f"{i}|" for i in n), *(f"{i}," for i in m), *(f"{i};" for i in m), *(f"{i}\n" for i in m)]

    def ids(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words, in another order, and their sizes; the first tokenizer's ids and how many each word has; the second one's."""
        one, longest = self.a.words.encode_ordinary, self.a.longest
        plain, odd = words, [word for word in words if len(word) > longest or _SPACE.search(word)]
        if odd:
            apart = set(odd)
            plain = [word for word in words if word not in apart]
            words = plain + odd
        # a word after a single space begins a token: plain words go together, and their byte ends tell them apart
        ids = one(" " + " ".join(plain)) if plain else []
        ends = np.cumsum(self.sizes_a[ids])
        sizes = _sizes(words)
        cuts = np.searchsorted(ends, np.cumsum(sizes[: len(plain)])) + 1
        many = np.diff(cuts, prepend=0).tolist()
        for word in odd:
            # the exact library copes best with endless words
            more = self.a.whole.encode(" " + word, add_special_tokens=False).ids if len(word) > longest else one(" " + word)
            ids += more
            many.append(len(more))
        other = self.b.encode(words, num_threads=1)
        counts = np.fromiter(map(len, other), np.int64, len(other))
        return words, sizes, np.array(ids, np.int64), np.array(many, np.int64), np.fromiter(chain.from_iterable(other), np.int64, int(counts.sum())), counts

    def come_back(self, words: list[str], sizes: np.ndarray, a: np.ndarray, many_a: np.ndarray, b: np.ndarray, many_b: np.ndarray) -> np.ndarray:
        """Which words the tokens of both give again."""
        want, ends = f" {' '.join(words)}".encode(), np.cumsum(sizes)
        back = np.ones(len(words), bool)
        for tokens, each, ids, many in ((self.bytes_a, self.sizes_a, a, many_a), (self.bytes_b, self.sizes_b, b, many_b)):
            got = b"".join(map(tokens.__getitem__, ids.tolist()))
            stops = np.concatenate(([0], np.cumsum(each[ids])))[np.cumsum(many)]
            if got != want or (stops != ends).any():
                cuts, wanted = [0, *stops.tolist()], [0, *ends.tolist()]
                back &= np.array([got[cuts[i] : cuts[i + 1]] == want[wanted[i] : wanted[i + 1]] for i in range(len(words))], bool)
        return back

    def align(self, words: list[str], with_groups: bool = True) -> Aligned:
        words, sizes, a, many_a, b, many_b = self.ids(words)
        back = self.come_back(words, sizes, a, many_a, b, many_b)
        if not back.all():
            a, b = a[np.repeat(back, many_a)], b[np.repeat(back, many_b)]
        figures = np.zeros((len(words), 4), np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])  # both run over the same bytes
        stops = np.cumsum(sizes[back])
        at = np.searchsorted(ends_b, ends_a)
        both = ends_b[at] == ends_a  # here groups end
        last_a, last_b = np.flatnonzero(both), at[both]
        shared = np.zeros(len(b), bool)
        shared[last_b] = True
        # between two neighbouring ends, of either side, lies just one link
        link_ends = np.sort(np.concatenate((ends_a, ends_b[~shared])))
        pairs = a[np.searchsorted(ends_a, link_ends)] << _SHIFT | b[np.searchsorted(ends_b, link_ends)]
        counted = (ends_a, ends_b, ends_a[last_a], link_ends)
        figures[back] = np.column_stack([np.diff(np.searchsorted(x, stops, "right"), prepend=0) for x in counted])
        return Aligned(words, back, figures, pairs, self._write(back, a, b, last_a, last_b, both, shared, ends_b, stops) if with_groups else [])

    def _write(self, back: np.ndarray, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, both: np.ndarray, shared: np.ndarray, ends_b: np.ndarray, stops: np.ndarray) -> list[str]:
        """The words' groups, each ``a1,a2|b1;a3|b2,b3``."""
        n, m = len(self.bytes_a), len(self.bytes_b)
        before = np.concatenate(([0], last_b + 1))[np.cumsum(both) - both]  # tokens of b in earlier groups
        upto = (last_a + 1)[np.cumsum(shared) - shared]  # tokens of a up to the group's end
        close = np.zeros(len(b), bool)
        close[np.searchsorted(ends_b, stops)] = True
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before] = a + n * both
        order[np.arange(len(b)) + upto] = 2 * n + b + m * shared + m * close
        lines = iter("".join(map(self.written.__getitem__, order.tolist())).split("\n"))
        return [next(lines) if whole else "" for whole in back.tolist()]


def _sizes(words: list[str]) -> np.ndarray:
    """Bytes of the words, each after a space."""
    return np.fromiter(map(len, map(str.encode, words)), np.int64, len(words)) + 1


def oddly_spaced(text: str) -> bool:
    """Whether some white space is not a single space between two words; most texts are settled by plain searches."""
    if "  " in text or "\n " in text or " \n" in text or text[:1].isspace() or text[-1:].isspace():
        return True
    return bool(_OTHER_SPACE.search(text)) and bool(_ODD_SPACE.search(text))


def stretches(text: str) -> Iterator[list[str]]:
    """The text's words, a stretch at a time. Between two words is one space and no other white space."""
    start = 0
    while start <= len(text):
        cut = _CUT.search(text, start + _STRETCH) if len(text) - start > _STRETCH else None
        part = text[start : cut.start()] if cut else text[start:]
        yield _CUT.split(part) if oddly_spaced(part) else part.split(" ")
        if not cut:
            return
        start = cut.end()


class Known:
    """Pairs of known counts, sorted: how many links hold them, and whether that is the most of their b id."""

    def __init__(self, pairs: np.ndarray = np.zeros(0, np.int64), n: np.ndarray = np.zeros(0, np.int64), top: np.ndarray = np.zeros(0, bool)):
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], np.iinfo(np.int64).max)  # no pair is as large as the last one
        self.n, self.top = np.append(n[order], 0), np.append(top[order], False)

    def look(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the pairs are known; their counts and whether these are the most, else zeros."""
        at = np.searchsorted(self.pairs, pairs)
        held = self.pairs[at] == pairs
        return held, np.where(held, self.n[at], 0), (self.top[at] & held).astype(np.int64)


class Words(dict):
    """word -> its number; groups, links' pairs of unknown counts and figures by number.

    figures: tokens of a, tokens of b, groups, links; then, by the pairs whose counts are ``known`` here, the
    links of their b id's commonest pair and the sum of counts. The words to ``keep`` stay; all others are
    forgotten at once when there are more than ``remembered`` of them.
    """

    def __init__(self, align: Aligner, remembered: int):
        self.align, self.remembered = align, remembered
        self.known = Known()
        self.keep: set[str] = set()
        self.version = None
        self.held = 0
        self._hold([])

    def _hold(self, words: list[str]) -> None:
        numbers = [self[word] for word in words]
        self.groups = [self.groups[n] for n in numbers] if numbers else []
        self.pairs = [self.pairs[n] for n in numbers] if numbers else []  # numbers of 64 bits, packed
        held = self.figures[numbers] if numbers else np.zeros((0, 6), np.int64)
        self.figures = np.concatenate([held, np.zeros((max(1024, len(held)), 6), np.int64)])
        self.clear()
        self.update(zip(words, range(len(words)), strict=True))
        self.open: set[int] = set()  # words with pairs whose counts are not known here
        self.wrong: set[str] = set()  # words that do not come back from their tokens
        self.bound = len(words) + self.remembered
        self.held += 1  # numbers from before are void
        self.open.update(number for number, packed in enumerate(self.pairs) if packed)

    def forget(self) -> None:
        self._hold([word for word in self if word in self.keep and word not in self.wrong])

    def know(self, version: int | None, read: Callable[[], tuple[Known, set[str]]]) -> None:
        """Take in the commonest pairs' counts and the words to keep, once for each version."""
        if version != self.version:
            self.keep = set()
            self.forget()
            self.version, (self.known, self.keep) = version, read()

    def learn(self, words: list[str]) -> None:
        """Align words that are not here yet. Only pairs whose counts are not known here are kept."""
        if not words:
            return
        start, found = len(self.groups), self.align.align(words)
        stop = start + len(words)
        self.wrong.update(word for word, back in zip(found.words, found.back.tolist(), strict=True) if not back)
        held, n, top = self.known.look(found.pairs)
        ends = np.cumsum(found.figures[:, 3])
        sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[ends], prepend=0) for x in (top, n)]
        self.groups += found.groups
        kept, unknown = [b""] * len(words), np.flatnonzero(~held)
        if len(unknown):
            packed, where = found.pairs[unknown], np.searchsorted(ends, unknown, "right")
            first = np.flatnonzero(np.diff(where, prepend=-1))
            for word, i, j in zip(where[first].tolist(), first.tolist(), [*first[1:].tolist(), len(where)], strict=True):
                kept[word] = packed[i:j].tobytes()
                self.open.add(start + word)
        self.pairs += kept
        self.update(zip(found.words, range(start, stop), strict=True))
        while len(self.figures) < stop:
            self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
        self.figures[start:stop] = np.column_stack([found.figures, *sums])

    def take(self, words: list[str]) -> list[int] | None:
        """The words' numbers; None if one does not come back from its tokens."""
        if len(self) > self.bound:
            self.forget()
        numbers = list(map(self.get, words))
        if None in numbers:
            self.learn(list({word for word, number in zip(words, numbers, strict=True) if number is None}))
            numbers = list(map(self.__getitem__, words))
        return numbers if not self.wrong or self.wrong.isdisjoint(words) else None

    def document(self, text: str | None) -> Iterator[tuple[list[str], list[int]]]:
        """Words and numbers, a stretch at a time; nothing for a text that does not come back as a whole."""
        if not text or len(text) > _STRETCH and any(self.take(words) is None for words in stretches(text)):
            return
        for words in stretches(text):
            numbers = self.take(words)
            if numbers is not None:
                yield words, numbers

    def documents(self, texts: list[str | None], together: int = 64) -> Iterator[Iterator[list[int]]]:
        """For each text its words' numbers, a stretch at a time. New words of several short texts are learnt at once."""
        for i in range(0, len(texts), together):
            if len(self) > self.bound:
                self.forget()
            some = texts[i : i + together]
            split = [next(stretches(text)) if text and len(text) <= _STRETCH else None for text in some]
            numbers = [words and list(map(self.get, words)) for words in split]
            new: set[str] = set()
            for words, found in zip(split, numbers, strict=True):
                if words and None in found:
                    new.update(word for word, number in zip(words, found, strict=True) if number is None)
            self.learn(list(new))
            held = self.held
            for n, (text, words) in enumerate(zip(some, split, strict=True)):
                if words is None:
                    yield (found for _, found in self.document(text))
                elif self.wrong and not self.wrong.isdisjoint(words):
                    yield iter(())
                elif None in numbers[n] or self.held != held:  # words were new, or numbers changed since
                    yield iter([list(map(self.__getitem__, words))] if self.held == held else filter(None, [self.take(words)]))
                else:
                    yield iter([numbers[n]])


def remembered_words(path_a: str, path_b: str, remembered: int) -> Words:
    """One for each worker process, kept from task to task."""
    return kept(("words", path_a, path_b, remembered), lambda: Words(Aligner(path_a, path_b), remembered))


def word_counts(docs: DataFrame, path_a: str, path_b: str, text_col: str, remembered: int, trusting: bool) -> DataFrame:
    """Columns word, n: the words of all texts that come back from their tokens.

    ``trusting``: texts of plain characters are not looked at; whoever aligns the words finds out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        words, counts = remembered_words(path_a, path_b, remembered), Counter()
        for b in batches:
            for text in column(b, "t"):
                if trusting and text and _PLAIN.fullmatch(text):
                    found = stretches(text)
                else:
                    found = (part for part, _ in words.document(text))
                for part in found:
                    counts.update(part)
                    if len(counts) > 2 * remembered:
                        yield from batches_of({"word": list(counts), "n": list(counts.values())}, schema)
                        counts.clear()
        yield from batches_of({"word": list(counts), "n": list(counts.values())}, schema)

    found = docs.select(F.col(text_col).alias("t")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def pair_counts(counts: DataFrame, path_a: str, path_b: str, remembered: int = 200_000) -> DataFrame:
    """Columns a, b, n of (word, n): how many links hold the two ids linked. A word that does not come back: -1, -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
        align = remembered_words(path_a, path_b, remembered).align
        for b in batches:
            asked: dict[str, int] = {}
            for word, n in zip(column(b, "word"), b.column(1).to_pylist(), strict=True):
                asked[word] = asked.get(word, 0) + n
            found = align.align(list(asked), with_groups=False)
            times = np.repeat(np.array([asked[word] for word in found.words], np.int64), found.figures[:, 3])
            pairs, place = np.unique(found.pairs, return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, place, times)
            wrong = [-1] * (not found.back.all())
            yield from batches_of({"a": [*(pairs >> _SHIFT), *wrong], "b": [*(pairs & ((1 << _SHIFT) - 1)), *wrong], "n": [*n, *wrong]}, schema)

    return counts.select("word", "n").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def corpus_counts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", remembered: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(word, n) and (a, b, n) of the whole corpus, stored. Each distinct word is aligned once."""
    for trusting in (True, False):
        words = stored(word_counts(docs, path_a, path_b, text_col, remembered, trusting))
        pairs = stored(pair_counts(words, path_a, path_b, remembered))
        if pairs.where("a < 0").isEmpty():
            break
    return words, pairs


def commonest(counts: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows of the largest n, cut between eighths of powers of two."""
    level = F.floor(F.log2("n") * 8)
    rows = counts.groupBy(level.alias("level")).count().collect()
    least, held = None, 0
    for row in sorted(rows, key=lambda r: -r["level"]):
        held += row["count"]
        if held > bound:
            break
        least = row["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def alignments(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = True,
    known: int = 1 << 18, remembered: int = 200_000,
) -> DataFrame:
    """Columns ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups: a row for each row of ``docs``.

    path_a: a byte-level vocabulary, given a space and the text; path_b: a sentencepiece file, which adds the
    space. Strings of special tokens are plain text. groups: ``a1,a2|b1;a3|b2,b3`` (null unless
    ``with_groups``). n_best: links whose pair is the commonest of its b id, ties included; count_sum: the
    counts of all links' pairs.

    Texts that are null, empty or do not come back from their tokens have no tokens: zeros and empty strings,
    the checksum too. Null ids stay; repeated rows are rows of their own and count again; no rows, no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    words, counts = corpus_counts(docs, path_a, path_b, text_col, remembered)
    best = counts.groupBy("b").agg(F.max("n").alias("best"))  # as many rows as the vocabulary has ids
    many = commonest(counts, known).join(F.broadcast(best), "b").toArrow()
    a, b, n, top = (many[c].to_numpy() for c in ("a", "b", "n", "best"))
    priced = Known(a << _SHIFT | b, n, n == top)
    keep = commonest(words.where(F.length("word") <= 40), known).select("word").toArrow()["word"].to_pylist()
    sent = spark.sparkContext.broadcast((priced, set(keep)))
    version = uuid.uuid4().int
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    figures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = f"row long, id {source.schema['id'].dataType.simpleString()}, {', '.join(f'{f} long' for f in figures)}, groups_sha256 string, groups string, pair array<long>, times array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = remembered_words(path_a, path_b, remembered)
        words.know(version, lambda: sent.value)
        for b in batches:
            rows, sums, groups, pair, times = [], [], [], [], []
            for document in words.documents(column(b, "t")):
                total, digest, parts, left = np.zeros(6, np.int64), hashlib.sha256(), [], Counter()
                for numbers in document:
                    total += words.figures[numbers].sum(axis=0)
                    line = ";".join(map(words.groups.__getitem__, numbers))
                    digest.update((";" + line if parts else line).encode())
                    parts.append(line if with_groups else "")
                    if not words.open.isdisjoint(numbers):
                        for number in filter(words.open.__contains__, numbers):
                            left.update(array("q", words.pairs[number]))
                rows.append(total)
                sums.append(digest.hexdigest() if parts else "")
                groups.append(";".join(parts) if with_groups else None)
                pair.append(list(left))
                times.append(list(left.values()))
            table = np.stack(rows) if rows else np.zeros((0, 6), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(table[:, i]) for i in range(6)], pa.array(sums, pa.string()),
                 pa.array(groups, pa.string()), pa.array(pair, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                names=["row", "id", *figures, "groups_sha256", "groups", "pair", "times"],
            )

    found = stored(source.mapInArrow(run, schema))
    few = found.where(F.size("pair") > 0).select("row", F.explode(F.arrays_zip("pair", "times")).alias("p")).select(
        "row", F.shiftright("p.pair", _SHIFT).alias("a"), F.col("p.pair").bitwiseAND((1 << _SHIFT) - 1).alias("b"), "p.times"
    )
    priced = split_join(few, counts, ["a", "b"]).join(F.broadcast(best), "b")
    more = priced.groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    whole = found.drop("pair", "times").join(more, "row", "left")
    whole = whole.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
    whole = whole.withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
    return whole.drop("row", "more_sum", "more_best").withColumnRenamed("id", id_col)
