"""Operator 1: log-likelihood of whole documents under a gated recurrent language model.

Words are counted over all training documents. Every task then trains a copy of one small model (see
``gated``) on its own documents by truncated backpropagation, and the copies are averaged, each weighing as
many tokens as it has seen. Words that are not predicted one by one share the model's tail in proportion to
their counts, so the model gives a probability to exactly the events that the unigram base does: each known
word, and one unknown.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave.llm import gated
from filingweave.llm.common import batches_of, column, id_remainder, stored, text_words
from filingweave.operators.joins import split_join

#: The token that closes a document: white space, so it is not a word.
END = b"\n"
#: At most so many words' counts are known to every task; the counts of rarer ones are joined.
LOCAL_WORDS = 200_000
#: Tokens that a task works on at once.
_CHUNK = 1_500_000
_BLOCK = 8192


@dataclass
class Vocabulary:
    words: list[bytes]  # by frequency; the first gated.HEAD are predicted one by one
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def head(self) -> np.ndarray:
        return self.counts[: gated.HEAD]

    @property
    def tail_mass(self) -> float:
        """Smoothed mass of the tail's known words and of the unknown one."""
        return self.tokens - float(self.head.sum()) + 0.5 * (self.distinct - len(self.head)) + 0.5


def corpus_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Columns word, n over all texts, ``END`` among them; summed within a task before the shuffle."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for b in batches:
            for text in column(b, "t"):
                counts.update(text_words(text))
            counts[END] += b.num_rows
            if len(counts) > 500_000:
                yield from batches_of({"word": list(counts), "n": list(counts.values())}, schema)
                counts.clear()
        yield from batches_of({"word": list(counts), "n": list(counts.values())}, schema)

    parts = docs.select(F.col(text_col).alias("t")).mapInArrow(run, "word binary, n long")
    return parts.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, local: int = LOCAL_WORDS) -> Vocabulary:
    """The commonest words, down to a count that leaves at most ``local`` (or the head, if ties allow none)."""
    # words by the size of their count, some hundred rows at most
    steps = F.floor(F.log2("n") * 16).cast("int").alias("size")
    sizes = counts.groupBy(steps).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"), F.sum("n").alias("n"))
    total, distinct, least, taken = 0, 0, None, 0
    for r in sorted(sizes.collect(), key=lambda r: -r["size"]):
        total, distinct = total + r.n, distinct + r.words
        if distinct <= local:
            least, taken = r.least, distinct
    if distinct and taken < min(distinct, gated.HEAD + 1):
        top = counts.orderBy(F.desc("n"), "word").limit(gated.HEAD + 1)
        top = top.union(counts.where(F.col("word") == F.lit(END))).distinct().toPandas()
    else:
        top = counts.where((F.col("n") >= F.lit(least)) | (F.col("word") == F.lit(END))).toPandas()
    ranked = sorted(zip(top.n.tolist(), map(bytes, top.word), strict=True), key=lambda x: (-x[0], x[1]))
    words, n = [w for _, w in ranked], [c for c, _ in ranked]
    at = words.index(END) if END in words else None
    if at is not None and at >= gated.HEAD:  # few, long documents
        words.insert(gated.HEAD - 1, words.pop(at))
        n.insert(gated.HEAD - 1, n.pop(at))
    return Vocabulary(words, np.array(n, np.int64), total, distinct)


def _head_numbers(words: list[bytes]) -> dict[bytes, int]:
    return {w: i for i, w in enumerate(words[: gated.HEAD])}


def trained(docs: DataFrame, text_col: str, known: Vocabulary, start: gated.Weights, rate: float, tasks: int | None = None) -> gated.Weights:
    """The average of the copies that the tasks train on their documents, from ``start``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((known.words[: gated.HEAD], start))
    size = len(gated.flat(start))
    schema = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("tokens", pa.float64()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weights = sent.value
        numbers = _head_numbers(head)
        end, found = numbers[END], numbers.get
        learner = gated.Learner({k: v.copy() for k, v in weights.items()}, rate)
        seen, held, texts = 0, 0, []
        for b in batches:
            for text in column(b, "t"):
                words = text_words(text)
                words.append(END)
                texts.append(np.fromiter(map(found, words, repeat(gated.TAIL)), np.int32, len(words)))
                held += len(words)
            if held >= _CHUNK:
                seen += gated.learn(learner, texts, end)
                held, texts = 0, []
        seen += gated.learn(learner, texts, end)
        if seen:
            values = gated.flat(learner.w).astype(np.float64)
            parts = [values[at : at + _BLOCK].tobytes() for at in range(0, size, _BLOCK)]
            n, salt = len(parts), TaskContext.get().partitionId()
            columns = {"block": range(n), "salt": [salt] * n, "tokens": [float(seen)] * n, "v": parts}
            yield from batches_of({k: list(v) for k, v in columns.items()}, schema)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, weight, total = None, 0.0, None

        def told() -> Iterator[pa.RecordBatch]:
            if key is not None:
                row = {"block": [key[0]], "salt": [key[1]], "tokens": [weight], "v": [(total / weight).tobytes()]}
                yield from batches_of(row, schema)

        for b in batches:
            for block, salt, tokens, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (block, salt) != key:
                    yield from told()
                    key, weight, total = (block, salt), 0.0, 0.0
                weight += tokens
                total = total + np.frombuffer(v, np.float64) * tokens
        yield from told()

    ddl = "block int, salt int, tokens double, v binary"
    copies = docs.select(F.col(text_col).alias("t"))
    copies = (copies.repartition(tasks) if tasks else copies).mapInArrow(run, ddl)
    # Averages of averages: no task holds more copies of a block than the root of the number of tasks.
    salts = max(1, int((tasks or docs.rdd.getNumPartitions()) ** 0.5))
    for n in (salts, 1):
        copies = copies.withColumn("salt", F.col("salt") % n).repartition("block", "salt")
        copies = copies.sortWithinPartitions("block", "salt").mapInArrow(mean, ddl)
    rows = sorted(copies.collect(), key=lambda r: r.block)  # one model
    if not rows:
        return start
    return gated.shaped(np.concatenate([np.frombuffer(r.v, np.float64) for r in rows]), start)


def fit(docs: DataFrame, counts: DataFrame, id_col: str, text_col: str, first: int = 1500, rate: float = 0.01) -> tuple[Vocabulary, gated.Weights | None]:
    """Vocabulary and weights, learnt from all ``docs``.

    About ``first`` documents, chosen by a hash of the id, give all tasks the same start, without which the
    average of their copies would mean little.
    """
    known = vocabulary(counts)
    if not known.tokens:
        return known, None
    head = known.head.astype(float)
    weights = gated.fresh(head, known.tokens - head.sum())
    documents = int(known.counts[known.words.index(END)])
    some = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.length(text_col)), F.lit(-(-documents // first))) == 0)
    weights = trained(some, text_col, known, weights, rate, tasks=1)
    return known, trained(docs, text_col, known, weights, rate / 2)


def scored(docs: DataFrame, id_col: str, text_col: str, known: Vocabulary, weights: gated.Weights | None) -> DataFrame:
    """Rows of documents (word null) with what a task knows, and a row for each of their rarer words.

    row: the document's number, unique in this table. base and score lack the rarer words' shares.
    """
    sent = docs.sparkSession.sparkContext.broadcast((known, weights))
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"))
    names = ["n_tokens", "n_known", "base", "score"]
    ddl = f"row long, doc {source.schema['doc'].dataType.simpleString()}, n_tokens long, n_known long, base double, score double, word binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = sent.value
        numbers = {w: i for i, w in enumerate(known.words)}
        found, end = numbers.get, numbers.get(END, -1)
        share = np.log10(np.append(known.counts + 0.5, 1.0))  # -1, a rarer word, adds its share later
        whole = np.log10(known.tokens + 0.5 * (known.distinct + 1))
        tail = np.log10(known.tail_mass)
        row = TaskContext.get().partitionId() << 40
        docs, texts, rare, held, id_type = [], [], [], 0, None

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal row, docs, texts, rare, held
            n = np.array([len(x) for x in texts], np.int64)
            local = np.array([share[x].sum() for x in texts])
            n_known = np.array([(x >= 0).sum() for x in texts])
            base = local - n * whole
            score = base.copy()
            if weights is not None:
                heads = [np.where((x < 0) | (x >= gated.HEAD), gated.TAIL, x) for x in texts]
                inside = [share[x[h == gated.TAIL]].sum() - tail * (h == gated.TAIL).sum() for x, h in zip(texts, heads, strict=True)]
                score = gated.scores(weights, heads, end) / np.log(10) + np.array(inside)
            rows = np.arange(row, row + len(texts))
            of = np.repeat(rows, [len(r) for r in rare])
            words = [w for r in rare for w in r]
            none = [None] * len(words)
            arrays = [pa.array(np.concatenate([rows, of])), pa.array(docs + none, id_type)]
            arrays += [pa.array(list(x) + none, t) for x, t in zip((n, n_known, base, score), (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
            arrays.append(pa.array([None] * len(texts) + words, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc", *names, "word"])
            row += len(texts)
            docs, texts, rare, held = [], [], [], 0

        for b in batches:
            id_type = b.schema.field(0).type
            for doc, text in zip(column(b, "doc"), column(b, "t"), strict=True):
                words = text_words(text)
                words.append(END)
                line = np.fromiter(map(found, words, repeat(-1)), np.int32, len(words))
                rare.append([words[i] for i in np.flatnonzero(line < 0).tolist()])
                docs.append(doc)
                texts.append(line)
                held += len(line)
            if held >= _CHUNK:
                yield from told()
        if texts:
            yield from told()

    return source.mapInArrow(run, ddl)


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, kept_out: int = 1, **learning
) -> DataFrame:
    """Columns ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row.

    Learns from documents whose id's crc32 modulo ``modulus`` is not ``kept_out``. Scores are log10
    probabilities of the whole text and its end. base_score: the smoothed unigram model.

    Null and empty texts are the end alone. Null ids count as an empty text in the crc32. Repeated rows
    repeat, and are learnt from as often. Without training documents both scores are the base's.
    """
    held = id_remainder(id_col, modulus) == kept_out
    training = docs.where(~held).select(id_col, text_col)
    counts = stored(corpus_counts(training, text_col))
    known, weights = fit(training, counts, id_col, text_col, **learning)
    marked = stored(scored(docs, id_col, text_col, known, weights))
    rare = marked.where("word is not null").select("row", "word")
    shares = split_join(rare, counts, ["word"], "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("share"), F.count("n").alias("known")
    )
    scores = marked.where("word is null").join(shares, "row", "left")
    share = F.coalesce("share", F.lit(0.0))
    return scores.select(
        F.col("doc").alias(id_col),
        (id_remainder("doc", modulus) == kept_out).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + share).alias("base_score"),
        (F.col("score") + share).alias("score"),
    )
