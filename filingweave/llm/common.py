"""What the operators share: sessions, row keys, handed-on tables, words, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.session import scratch, ship, tune

#: Rows and bytes of one batch handed to Python: texts can be long.
_BATCH_ROWS, _BATCH_BYTES = 2000, "8m"
#: What a worker process keeps from task to task, for one operator at a time.
_KEPT: dict[tuple, object] = {}


def ready(spark: SparkSession) -> SparkSession:
    """Session settings for the operators; executors get this package."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    ship(spark)
    return spark


def stored(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Write once into the shared folder and read back: later jobs share it and survive lost executors.

    The place is added to ``paths``, for callers that ``discard`` it when nothing reads it any more.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that ``stored`` wrote and that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, once for each worker process; what another operator kept there goes."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Hand this process's free memory back to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def let_go() -> None:
    """Forget what other operators kept in this worker process."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, in a worker that holds nothing of other operators and gives memory back at the end."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        yield from run(batches)
        give_back()

    return alone


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it, so that it clashes with no column of ``docs``, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*columns: str | Column) -> Column:
    """A struct of the columns: structs with equal nulls inside are equal, also in joins."""
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns])


def text_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart by id and text, so that ids that are null or used twice do no harm."""
    return F.struct(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.length(F.col(text_col)).alias("n"),
    )


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def text_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space, tab to carriage return), A-Z lower-cased, as UTF-8.

    Of a str with lone surrogates the bytes are kept.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_ALNUM = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_ALNUM).split() if text else []


def batches_of(columns: dict[str, Sequence], schema: pa.Schema, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Cut equally long columns into record batches."""
    table = pa.Table.from_pydict(columns, schema=schema)
    yield from table.to_batches(max_chunksize=rows)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
