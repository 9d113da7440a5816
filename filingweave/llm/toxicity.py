"""Operator 5: toxicity by class-conditional Kneser-Ney models.

Word bigrams of toxic and of ordinary documents are counted apart, but both models back off to one and the
same distribution: continuation counts (how many different words a word follows) of both classes together.
So an expression too rare to be discounted looks alike to both. A class's discount grows with its size: a
count speaks from the same relative frequency on in either class.

Log-likelihood ratios are compared per word, over the whole text and over its most toxic stretch; a logistic
regression on documents kept out of the counts turns them into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import alnum_words, batches_of, column, id_remainder, lean, stored

_START = b"^"  # not a word
FEATURES = 6


@dataclass
class Model:
    """Log ratios toxic : ordinary. Words are numbered; number -1 is every word that is not kept."""

    words: dict[bytes, int]
    word_ratio: np.ndarray  # of backed-off words; the last entry is for -1
    backoff_ratio: np.ndarray  # of the weight a preceding word leaves to the backoff; the last for -1
    pairs: np.ndarray  # sorted preceding * len(words) + word
    pair_ratio: np.ndarray
    stretch: int
    weights: np.ndarray | None = None  # of the features and 1
    constant: float = 0.0  # the score where nothing could be learnt

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text, for single words and for words after words: the ratio per word, over the root of the
        number of words, and per word of the best stretch.
        """
        found = self.words.get
        start = self.words.get(_START, -1)
        ids, ends = [], []
        for text in texts:
            ids.append(start)
            ids += [found(w, -1) for w in alnum_words(text)]
            ends.append(len(ids))
        flat = np.array(ids, np.int64)
        out = np.zeros((len(texts), FEATURES))
        if not len(flat):
            return out
        before = np.roll(flat, 1)
        alone = self.word_ratio[flat]
        ratio = alone + self.backoff_ratio[before]
        if len(self.pairs):
            key = before * len(self.words) + flat
            key[(before < 0) | (flat < 0)] = -1
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[at] == key
            ratio[hit] = self.pair_ratio[at[hit]]
        begin = 0
        for i, end in enumerate(ends):
            n = end - begin - 1
            if n:
                size = min(self.stretch, n)
                for k, own in enumerate((alone, ratio)):
                    sums = np.concatenate(([0.0], np.cumsum(own[begin + 1 : end])))
                    best = (sums[size:] - sums[:-size]).max() / self.stretch
                    out[i, 3 * k : 3 * k + 3] = sums[-1] / n, sums[-1] / np.sqrt(n), best
            begin = end
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.constant)
        x = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -500, 500)))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bound: int, modulus: int, kept_out: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of at most ``bound`` labelled documents of a class, equal texts once; all labels' counts."""
    usable = labels.where((id_remainder(id_col, modulus) != kept_out) & F.col(label_col).isNotNull())
    one = usable.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in one.groupBy("toxic").count().collect()}  # two rows
    chosen = [one.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(bound) for c in (0, 1)]
    chosen = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * bound rows of two numbers
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(chosen, "id")
    return stored(texts.select("t", "toxic").dropDuplicates(["t", "toxic"])), counts


def bigram_counts(sample: DataFrame) -> DataFrame:
    """Columns h, w, toxic, ordinary."""
    schema = pa.schema([("h", pa.binary()), ("w", pa.binary()), ("toxic", pa.int64()), ("ordinary", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def told() -> Iterator[pa.RecordBatch]:
            for c, counter in enumerate(counts):
                h, w = zip(*counter, strict=True) if counter else ((), ())
                n = list(counter.values())
                none = [0] * len(n)
                yield from batches_of({"h": h, "w": w, "toxic": n if c else none, "ordinary": none if c else n}, schema)
                counter.clear()

        for b in batches:
            for text, toxic in zip(column(b, "t"), column(b, "toxic"), strict=True):
                words = alnum_words(text)
                counts[toxic].update(zip([_START, *words], words, strict=False))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield from told()
        yield from told()

    parts = sample.mapInArrow(lean(run), "h binary, w binary, toxic long, ordinary long")
    return parts.groupBy("h", "w").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


#: The discounts tried; the documents kept out of the counts choose one.
DISCOUNTS = (2.5, 5.0, 10.0, 20.0)
_CLASSES = ("toxic", "ordinary")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    bound: int = 6000, prevalence: float = 0.01, stretch: int = 12, modulus: int = 4, kept_out: int = 2,
) -> Model:
    """Learns from at most ``bound`` labelled documents of each class (those first by a hash of the id).

    A quarter of them, by a hash of the text, only choose the discount and the weights of the score. The
    shared backoff mixes both classes' continuation counts as if ``prevalence`` of all text were toxic.
    """
    sample, labelled = training_sample(docs, labels, id_col, text_col, label_col, bound, modulus, kept_out)
    part = F.pmod(F.xxhash64("t"), F.lit(4))
    bigrams = stored(bigram_counts(sample.where(part != 0)))
    empty = Model({}, np.zeros(1), np.zeros(1), np.zeros(0, np.int64), np.zeros(0), stretch)
    follows = [F.count(F.when(F.col(c) > 0, 1)).alias(f"f{i}") for i, c in enumerate(_CLASSES)]
    sums = [F.sum(c).alias(f"n{i}") for i, c in enumerate(_CLASSES)]
    totals = bigrams.agg(*sums, *follows).first()
    total = np.array([totals.n0 or 0, totals.n1 or 0], float)
    if not total.all():
        both = sum(labelled.values())
        empty.constant = 1.0 if both and not labelled.get(0) else 0.0
        return empty
    cuts = [d * total / total.min() for d in DISCOUNTS]
    spare = [
        F.sum(F.least(F.col(c), F.lit(float(cut[i])))).alias(f"s{i}_{k}")
        for k, cut in enumerate(cuts)
        for i, c in enumerate(_CLASSES)
    ]
    strong = (F.col("toxic") > float(cuts[0][0])) | (F.col("ordinary") > float(cuts[0][1]))
    # What is kept exceeds a discount, so its number is bounded by that of the sample's words.
    unigrams = bigrams.groupBy("w").agg(*[F.sum(c).alias(c) for c in _CLASSES], *follows)
    mass = unigrams.agg(*spare).first()
    kept = unigrams.where(strong).toPandas()
    heads = bigrams.groupBy("h").agg(*sums, *spare, F.max(strong).alias("any")).where("any").toPandas()
    pairs = bigrams.where(strong).toPandas()
    words = {w: i for i, w in enumerate(sorted({bytes(w) for w in kept.w} | {bytes(h) for h in heads.h}))}
    numbers = [np.array([words[bytes(x)] for x in xs], np.int64) for xs in (kept.w, heads.h, pairs.h, pairs.w)]
    size, (at, where, h, w) = len(words), numbers
    shared = np.zeros(size)
    for i, weight in enumerate((prevalence, 1 - prevalence)):
        shared[at] += weight * kept[f"f{i}"].to_numpy(float) / totals[f"f{i}"]
    shared = np.maximum(shared, 1e-12)
    keys = h * size + w
    order = np.argsort(keys)
    models = []
    for k, cut in enumerate(cuts):
        left = np.array([mass[f"s{i}_{k}"] for i in (0, 1)]) / total
        share, backoff, seen = np.zeros((size, 2)), np.ones((size + 1, 2)), np.ones((size, 2))
        pair = np.zeros((len(pairs), 2))
        for i, name in enumerate(_CLASSES):
            share[:, i] = left[i] * shared
            share[at, i] += np.maximum(kept[name].to_numpy(float) - cut[i], 0) / total[i]
            n = heads[f"n{i}"].to_numpy(float)
            seen[where, i] = np.maximum(n, 1)
            backoff[where, i] = np.where(n > 0, heads[f"s{i}_{k}"].to_numpy(float) / np.maximum(n, 1), 1.0)
            own = np.maximum(pairs[name].to_numpy(float) - cut[i], 0)
            pair[:, i] = own / seen[h, i] + backoff[h, i] * share[w, i]
        ratio = np.append(np.log(share[:, 0] / share[:, 1]), np.log(left[0] / left[1]))
        heads_ratio = np.log(backoff[:, 0] / backoff[:, 1])
        models.append(Model(words, ratio, heads_ratio, keys[order], np.log(pair[:, 0] / pair[:, 1])[order], stretch))
    return calibrated(models, sample.where(part == 0), labelled)


def calibrated(models: list[Model], sample: DataFrame, labelled: dict[int, int]) -> Model:
    """The model that tells the sample's classes apart best, with its weights."""
    sent = sample.sparkSession.sparkContext.broadcast(models)
    names = [f"x{i}" for i in range(FEATURES * len(models))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column(b, "t")
            x = np.hstack([m.features(texts) for m in sent.value])
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), b.column(1)], names=[*names, "toxic"])

    schema = ", ".join(f"{n} double" for n in names) + ", toxic int"
    rows = sample.select("t", "toxic").mapInArrow(lean(run), schema).toPandas()  # at most twice the bound
    y = rows.toxic.to_numpy(float)
    share = labelled[1] / sum(labelled.values())
    own = [max(1, int((y == c).sum())) for c in (0, 1)]
    weight = np.where(y > 0, share / own[1], (1 - share) / own[0]) * max(1, len(y))
    best = (np.inf, models[0])
    for i, model in enumerate(models):
        x = rows[names[FEATURES * i : FEATURES * (i + 1)]].to_numpy(float).reshape(-1, FEATURES)
        if 0 < y.sum() < len(y):
            loss, model.weights = logistic(x, y, weight)
        else:  # too little to calibrate on: only the ratio per word counts
            loss, model.weights = 0.0, np.array([1.0] + [0.0] * (FEATURES - 1) + [np.log(share / (1 - share))])
        if loss < best[0]:
            best = (loss, model)
    return best[1]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> tuple[float, np.ndarray]:
    """Newton's method; the mean loss and the weights of the columns and of 1."""
    scale = np.append(x.std(axis=0) + 1e-9, 1.0)
    z = np.column_stack([x, np.ones(len(x))]) / scale
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + ridge * w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(z @ w, -30, 30))), 1e-9, 1 - 1e-9)
    loss = -np.average(y * np.log(p) + (1 - y) * np.log(1 - p), weights=weight)
    return float(loss), w / scale


def without_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = 0.3, **learning,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``.

    Each row is judged alone: repeated rows go or stay together, and a null text counts as an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, **learning))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(sent.value.score(b.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    keep: list[str] | None = None, threshold: float = 0.3, modulus: int = 4, kept_out: int = 2, **learning,
) -> DataFrame:
    """Columns ``keep`` (the id), held_out, score, predicted: a row for each row of ``docs``.

    Learns only from labels whose id's crc32 modulo ``modulus`` is not ``kept_out``; scores read nothing but
    the text. Null, empty and wordless texts have no evidence and get the score that the logistic regression
    gives to none. Labels that are null, without a document or repeated do no harm (repeated: toxic if any).
    Without labels of both classes the score is 0, or 1 if all are toxic. Repeated rows repeat.
    """
    keep = list(keep or [id_col])
    model = fit(docs, labels, id_col, text_col, label_col, modulus=modulus, kept_out=kept_out, **learning)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    held = (id_remainder(id_col, modulus) == kept_out).alias("held_out")
    source = docs.select(*keep, held, F.col(text_col).alias("_scored"))
    schema = source.drop("_scored").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = pa.array(sent.value.score(column(b, "_scored")), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], score], names=[*b.schema.names[:-1], "score"])

    scored = source.mapInArrow(lean(run), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
