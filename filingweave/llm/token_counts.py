"""Operator 2: token counts of a unigram vocabulary without making tokens.

An Aho-Corasick automaton enumerates the vocabulary's matches in a word; dynamic programming carries, for
each end, the best score and the number of pieces. The tie rule is the exact tokenizer's: among equal scores
the longest last piece wins, and neighbouring unknown characters are one piece (or one for each byte).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import log

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import column

#: What a character outside the vocabulary costs beyond the lowest score (fixed value of the tokenizer).
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
_COUNTERS: dict[tuple, Counter] = {}


def zipf_scores(pieces: Sequence[str]) -> list[tuple[str, float]]:
    """Log-probabilities by rank, for a vocabulary file that is ordered by frequency and has no counts."""
    total = sum(1 / (rank + 1) for rank in range(len(pieces)))
    return [(piece, -log((rank + 1) * total)) for rank, piece in enumerate(pieces)]


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, its byte pieces among them, scored by rank."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    return zipf_scores([sp.id_to_piece(i) for i in range(sp.get_piece_size())])


class Counter(dict):
    """word -> (pieces, unknown pieces, score). Words are remembered, up to a bound.

    A text is cut before each space, and the space is written as a mark at the head of its word; the text
    begins with such a mark. So a word's best pieces do not depend on its neighbours.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]], byte_fallback: bool = True, remembered: int = 800_000):
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(reversed(pieces)).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        known = {piece for piece, _ in pieces}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in known for b in range(256))
        self.remembered = remembered

    def __missing__(self, word: str) -> tuple[int, int, float]:
        found = self.known(SPACE + word) or self.best(SPACE + word)
        if len(word) < 60:
            if len(self) >= self.remembered:
                self.clear()
            self[word] = found
        return found

    def known(self, marked: str) -> tuple[int, int, float] | None:
        """As ``best``, for words whose every character is a piece; None for others."""
        score, count = [0.0], [0]
        at, single, top, pieces = -1, True, 0.0, 0
        for end, (length, value) in self.automaton.iter(marked):
            if end != at:
                if not single or end != at + 1:
                    return None
                if end:
                    score.append(top)
                    count.append(pieces)
                start = end + 1 - length
                at, single, top, pieces = end, length == 1, value + score[start], count[start] + 1
                continue
            start = end + 1 - length
            candidate = value + score[start]
            if candidate > top:
                top, pieces = candidate, count[start] + 1
            if length == 1:
                single = True
        return (pieces, 0, top) if single and at == len(marked) - 1 else None

    def best(self, marked: str) -> tuple[int, int, float]:
        size = len(marked)
        matches: dict[int, list[tuple[int, float]]] = {}
        for end, hit in self.automaton.iter(marked):  # for each end the longest first
            matches.setdefault(end, []).append(hit)
        score, count, unknown, open_ = [0.0], [0], [0], [False]
        for end in range(size):
            top, start = None, end
            single = False
            for length, value in matches.get(end, ()):
                single |= length == 1
                candidate = value + score[end + 1 - length]
                if top is None or candidate > top:
                    top, start = candidate, end + 1 - length
            if not single:
                candidate = self.unknown + score[end]
                if top is None or candidate > top:
                    cost = len(marked[end].encode("utf-8", "surrogatepass")) if self.bytes else 1 - open_[end]
                    score.append(candidate)
                    count.append(count[end] + cost)
                    unknown.append(unknown[end] + (0 if self.bytes else 1 - open_[end]))
                    open_.append(True)
                    continue
            score.append(top)
            count.append(count[start] + 1)
            unknown.append(unknown[start])
            open_.append(False)
        return count[size], unknown[size], score[size]

    def __call__(self, text: str | None) -> tuple[int, int, float]:
        if not text:
            return 0, 0, 0.0
        text = text.replace(SPACE, " ")  # the mark itself is a space, as it is to the tokenizer
        words = text[text.startswith(" ") :].split(" ")
        n, unknown, score = zip(*map(self.__getitem__, words), strict=True)
        return sum(n), sum(unknown), sum(score)


def counter(path: str) -> Counter:
    """One for each worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(read_pieces(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id_col``, n_tokens, n_unknown, score: a row for each row of ``docs``.

    score: the sum of the best pieces' log-probabilities. Null and empty texts have no tokens and score 0;
    null ids and repeated rows stay. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"))
    schema = f"doc {source.schema['doc'].dataType.simpleString()}, n_tokens long, n_unknown long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for b in batches:
            rows = [count(t) for t in column(b, "t")]
            n, unknown, score = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(unknown, pa.int64()), pa.array(score, pa.float64())],
                names=["doc", "n_tokens", "n_unknown", "score"],
            )

    return source.mapInArrow(run, schema).withColumnRenamed("doc", id_col)
