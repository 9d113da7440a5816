"""Operator 6: packing documents into token sequences with bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document's tail goes into the window that it fills
best; when none has room, the fullest is filled up with the head of the tail and emitted. What is left open
at the end is joined, at first within the partition, then over groups of partitions, level by level.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import column, give_back, kept, stored

#: The byte-level vocabulary's pattern (fixed value, public).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space that is not a single space between two words: such texts are encoded as a whole.
_ODD_SPACE = re.compile(r"\s |  | \s|\A\s|\s\Z")


class Encoder(dict):
    """Ids of a byte-level BPE vocabulary file, as little-endian 32-bit bytes.

    A word after a single space is encoded alone: the pattern always cuts in front of such a space. Words are
    remembered, up to a bound. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, remembered: int = 300_000, longest: int = 2000):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        special = {t["content"] for t in held["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in held["model"]["vocab"].items()
            if token not in special
        }
        self.words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.remembered, self.longest = remembered, longest

    @cached_property
    def whole(self):
        """The exact library, loaded once a text asks for it."""
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(self.path)
        whole.encode_special_tokens = True
        return whole

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.words.encode_ordinary(" " + word), np.uint32).tobytes()
        if len(word) < 40:
            if len(self) >= self.remembered:
                self.clear()
            self[word] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = text.split(" ")
        if max(map(len, words)) > self.longest:  # the exact library copes best with endless words
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        if _ODD_SPACE.search(text):
            return np.array(self.words.encode_ordinary(text), np.uint32).tobytes()
        first = np.array(self.words.encode_ordinary(words[0]), np.uint32).tobytes()
        return first + b"".join(map(self.__getitem__, words[1:]))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> Encoder:
    """One for each worker process and file, as long as no other operator runs there."""
    return kept(("encoder", path), lambda: Encoder(path))


class Packer:
    """Open windows of one partition. A piece is (document, start, ids, tokens of the document)."""

    def __init__(self, size: int, windows: int):
        self.size, self.windows = size, windows
        self.rooms: list[tuple[int, int]] = []  # (room, window), by room
        self.held: dict[int, list] = {}
        self.opened = 0

    def add(self, doc, ids: bytes) -> Iterator[list]:
        """Yields the sequences that are now complete."""
        total = len(ids) // 4
        full = total - total % self.size
        for at in range(0, full, self.size):
            yield [(doc, at, ids[at * 4 : (at + self.size) * 4], total)]
        if full == total:
            return
        start, need = full, total - full
        at = bisect_left(self.rooms, (need, -1))
        if at == len(self.rooms) and len(self.rooms) >= self.windows:  # none fits: the fullest goes
            room, window = self.rooms.pop(0)
            done = self.held.pop(window)
            done.append((doc, start, ids[start * 4 : (start + room) * 4], total))
            yield done
            start, need = start + room, need - room
            at = bisect_left(self.rooms, (need, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            room, window = self.size, self.opened
            self.opened += 1
            self.held[window] = []
        self.held[window].append((doc, start, ids[start * 4 :], total))
        if room > need:
            insort(self.rooms, (room - need, window))
        else:
            yield self.held.pop(window)

    def rest(self) -> list:
        """The pieces still open, the fullest windows first."""
        return [piece for _, window in self.rooms for piece in self.held[window]]


def joined(pieces: list, size: int) -> tuple[list[list], list]:
    """Pieces in a row, cut into complete sequences; what is left over."""
    done, now, room = [], [], size
    for doc, start, ids, total in pieces:
        while ids:
            part = ids[: room * 4]
            now.append((doc, start, part, total))
            start, ids, room = start + len(part) // 4, ids[len(part) :], room - len(part) // 4
            if not room:
                done.append(now)
                now, room = [], size
    return done, now


class _Rows:
    """Collects pieces as columns. ``doc`` is a position in the batch or an id."""

    def __init__(self, id_type: pa.DataType, with_ids: bool):
        self.id_type, self.with_ids = id_type, with_ids
        self.rows: list[tuple] = []

    def sequence(self, number: int, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, number, offset, ids if self.with_ids else None))
            offset += len(ids) // 4

    def left(self, pieces: list) -> None:
        for n, (doc, start, ids, total) in enumerate(pieces):
            self.rows.append((doc, start, len(ids) // 4, None, total, None, n, ids))

    def batch(self, part: int) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 8
        types = [self.id_type, *[pa.int64()] * 6, pa.binary()]
        arrays = [pa.array(list(c), t) for c, t in zip(cols, types, strict=True)]
        arrays.append(pa.array([part] * len(self.rows), pa.int64()))
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


_NAMES = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]
_LEVEL, _PART = 1 << 56, 1 << 28


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
    windows: int = 64, end_id: int = 0, fan_in: int = 64, with_ids: bool = True,
) -> DataFrame:
    """Columns ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids: a row for each piece.

    A document is its ids and then ``end_id``. Every sequence holds ``size`` ids but for one, the last that
    remains when all partitions' leftovers have been joined. ids: little-endian unsigned 32-bit numbers
    (null unless ``with_ids``); ids_crc32: their checksum.

    Null and empty texts are the end id alone; null ids stay null; repeated rows are documents of their own;
    no rows, no pieces. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"))
    fields = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in _NAMES[1:])
    schema = f"doc {source.schema['doc'].dataType.simpleString()}, {fields}"
    end = np.array([end_id], np.uint32).tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer, rows, n = encoder(tokenizer), Packer(size, windows), None, 0
        for b in batches:
            rows = rows or _Rows(b.schema.field(0).type, with_ids)
            for doc, text in zip(column(b, "doc"), column(b, "t"), strict=True):
                for done in packer.add(doc, encode(text) + end):
                    rows.sequence(part * _PART + n, done)
                    n += 1
            yield rows.batch(part)
        if rows:
            yield from last(rows, part * _PART + n, packer.rest(), part)
        give_back()

    def last(rows: _Rows, number: int, pieces: list, part: int) -> Iterator[pa.RecordBatch]:
        complete, rest = joined(pieces, size)
        for n, done in enumerate(complete):
            rows.sequence(number + n, done)
        rows.left(rest)
        yield rows.batch(part)

    def merged(level: int, final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, pieces, rows = None, [], None

            def close() -> Iterator[pa.RecordBatch]:
                number = level * _LEVEL + now * _PART
                if final:
                    complete, rest = joined(pieces, size)
                    for n, done in enumerate([*complete, *([rest] if rest else [])]):
                        rows.sequence(number + n, done)
                    yield rows.batch(now)
                else:
                    yield from last(rows, number, pieces, now)

            for b in batches:
                rows = rows or _Rows(b.schema.field(0).type, with_ids)
                cols = [column(b, c) for c in ("doc", "start", "ids", "doc_tokens", "group")]
                for doc, start, ids, total, group in zip(*cols, strict=True):
                    if group != now and pieces:
                        yield from close()
                        pieces = []
                    now = group
                    pieces.append((doc, start, bytes(ids), total))
            if pieces:
                yield from close()

        return run

    level, out = 0, stored(source.mapInArrow(first, schema))
    done = out.where("sequence_id is not null")
    left = out.where("sequence_id is null")
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level += 1
        parts = -(-parts // fan_in)
        grouped = left.withColumn("group", F.floor(F.col("part") / fan_in).cast("long"))
        grouped = grouped.repartition("group").sortWithinPartitions("group", "part", "offset")
        out = grouped.mapInArrow(merged(level, parts == 1), schema)
        if parts == 1:
            done = done.union(out)
            break
        out = stored(out)
        done = done.union(out.where("sequence_id is not null"))
        left = out.where("sequence_id is null")
    return done.withColumnRenamed("doc", id_col).drop("part")
