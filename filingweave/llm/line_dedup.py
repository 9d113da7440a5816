"""Operator 13: frequent lines go everywhere but in the largest document that holds them.

Documents are taken in batches, from the largest ids down. The keys met so far lie in levelled runs: tables
cut into buckets by hash and sorted by it. A new batch is merged against the runs, which need no shuffle for
it: a key in none of them is new, and the batch's largest document holds it for good; every other line is a
later copy. Then the batch adds its keys as a run of its own, and as soon as a level has ``fan_in`` runs they
are compacted into one of the next level. The last compaction knows how many documents hold each key, and
only later copies ever meet it.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.llm.common import column, discard, stored, text_key
from filingweave.operators.joins import split_join
from filingweave.session import scratch

KEY = ["h1", "h2"]
_LATER_BYTES = bytes(range(0x80, 0xC0))
_PAIR = struct.Struct("<qq")


def line_key(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """128 bits of a line without white space around it, A-Z lower-cased; None if it is too short."""
    line = line.strip().lower()
    if len(line) < min_chars:
        return None
    if len(line) < 4 * min_chars and len(line.translate(None, _LATER_BYTES)) < min_chars:
        return None
    return _PAIR.unpack(xxhash.xxh3_128_digest(line))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Columns id, key, h1, h2: a row for each distinct key of a document's lines; key tells rows apart."""
    source = docs.select(F.col(text_col).cast("binary").alias("t"), F.col(id_col).alias("id"), text_key(id_col, text_col).alias("key"))
    kept = source.select("id", "key").schema
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["h1 long", "h2 long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, first, second = [], [], []
            for n, text in enumerate(column(b, "t")):
                found = {line_key(line, min_chars) for line in text.split(b"\n")} if text else set()
                found.discard(None)
                for h1, h2 in found:
                    at.append(n)
                    first.append(h1)
                    second.append(h2)
            rows = b.select(["id", "key"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["id", "key", *KEY]
            )

    return source.mapInArrow(run, schema)


def cuts(ids: DataFrame, batches: int) -> list:
    """The smallest id of each of ``batches`` ranges of about equally many rows, largest range first, but the last."""
    name = ids.columns[0]
    ranged = ids.dropna().repartitionByRange(4 * batches, F.col(name).desc())
    rows = ranged.groupBy(F.spark_partition_id()).agg(F.min(name).alias("low"), F.count("*").alias("n")).collect()
    lows, total, held = [], sum(r.n for r in rows), 0
    for r in sorted(rows, key=lambda r: r.low, reverse=True):
        held += r.n
        if held * batches >= (len(lows) + 1) * total:
            lows.append(r.low)
    return lows[:-1]


def batch_number(id_: Column, lows: list) -> Column:
    """0 for the largest ids. Null ids come last."""
    below = sum((F.when(id_ < F.lit(low), 1).otherwise(0) for low in lows), F.lit(0))
    return F.when(id_.isNull(), len(lows)).otherwise(below)


class Runs:
    """Levelled runs of (h1, h2, n, ...): each key once in a run, n the documents that hold it there.

    Runs are tables of ``buckets`` files, sorted, in the shared folder; compacted ones are removed.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_in: int):
        self.spark, self.buckets, self.fan_in = spark, buckets, fan_in
        self.levels: list[list[tuple[str, str]]] = []

    def add(self, keys: DataFrame, level: int = 0) -> DataFrame:
        """Write distinct keys as a run; the run as it lies."""
        name, path = f"filingweave_run_{uuid.uuid4().hex}", scratch(self.spark)
        split = keys.repartition(self.buckets, *KEY)
        split.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))
        return self.spark.table(name)

    def compact(self) -> None:
        """Every full level, from the newest runs on, becomes one run of the next."""
        level = 0
        while level < len(self.levels):
            full = self.levels[level]
            if len(full) >= self.fan_in:
                self.levels[level] = []
                self.add(self._merged(full), level + 1)
                self._remove(full)
            level += 1

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        """Plain scans: a union of bucketed scans would count as bucketed, but its keys are not met in one place."""
        rows = self.spark.read.schema("h1 long, h2 long, n long").parquet(*[path for _, path in runs])
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"))

    def _remove(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            discard(self.spark, path)

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def seen(self, keys: DataFrame) -> DataFrame:
        """``keys`` and a column seen: whether any run has the key."""
        for table in self.tables():
            known = table.select(*KEY, F.lit(True).alias("_in"))
            before = F.col("seen") if "seen" in keys.columns else F.lit(False)
            keys = keys.join(known.hint("merge"), KEY, "left").withColumn("seen", before | F.col("_in").isNotNull()).drop("_in")
        return keys if "seen" in keys.columns else keys.withColumn("seen", F.lit(False))

    def total(self) -> DataFrame:
        return self._merged([run for level in self.levels for run in level])

    def close(self) -> None:
        for level in self.levels:
            self._remove(level)
        self.levels = []


def later_copies(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, batches: int, fan_in: int
) -> DataFrame:
    """Columns key, h1, h2: the lines that go, a row for each key of each text that loses it."""
    spark = docs.sparkSession
    lows = cuts(docs.select(id_col), batches)
    lines = line_keys(docs, id_col, text_col, min_chars).withColumn("batch", batch_number(F.col("id"), lows))
    path = scratch(spark)
    lines.write.partitionBy("batch").parquet(path)
    runs = Runs(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in)
    copies, used = [], [path]
    for number in range(len(lows) + 1):
        batch = spark.read.schema(lines.schema).parquet(path).where(F.col("batch") == number).drop("batch")
        loose = F.max(F.col("id").isNull())  # rows without an id never hold a key
        keys = batch.groupBy(*KEY).agg(F.count_distinct("id").alias("n"), F.max("id").alias("top"), loose.alias("loose"))
        again = runs.add(runs.seen(keys)).where("seen or n > 1 or loose").select(*KEY, "seen", "top")
        later = split_join(batch, again, KEY).where("seen or id is null or id < top")
        copies.append(stored(later.select("key", *KEY), used))
        runs.compact()
    frequent = runs.total().where(F.col("n") >= min_docs).select(*KEY)
    gone = stored(split_join(reduce(DataFrame.unionByName, copies), frequent, KEY))
    runs.close()
    for old in used:
        discard(spark, old)
    return gone


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
    batches: int = 4, fan_in: int = 2,
) -> DataFrame:
    """Columns ``id_col``, n_lines, n_dropped, ``text_col``: a row for each row of ``docs``, text without the lines that go.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A key of ``min_chars``
    code points or more that ``min_docs`` documents hold loses all its lines but those of the largest id.
    Keys are told apart by 128 bits of hash.

    Documents are ids: rows with the same id are one document, and each loses or keeps a key's lines. Rows
    without an id are counted as no document; they hold no key and lose those that others have often enough.
    Null and empty texts are one empty line and come back as the empty text. Other columns are not read.
    """
    gone = later_copies(docs, id_col, text_col, min_chars, min_docs, batches, fan_in)
    lists = gone.groupBy("key").agg(F.collect_set(F.struct(*KEY)).alias("drop"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"), text_key(id_col, text_col).alias("key"))
    joined = split_join(source, lists, ["key"], "left").select("id", "t", "drop")
    schema = f"id {source.schema['id'].dataType.simpleString()}, n_lines long, n_dropped long, t string"

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_:
            counts, dropped, texts = [], [], []
            for text, drop in zip(column(b, "t"), column(b, "drop"), strict=True):
                lines = (text or b"").split(b"\n")
                kept = lines
                if drop:
                    out = {(d["h1"], d["h2"]) for d in drop}
                    kept = [line for line in lines if line_key(line, min_chars) not in out]
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["id", "n_lines", "n_dropped", "t"],
            )

    return joined.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "t": text_col})
