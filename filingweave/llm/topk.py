"""Operator 4: exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers and dealt into blocks. A block of the index holds, for each attribute and
each binary digit, a bitmap over the block's rows. For a query, the slices that its digits ask for are added
up with carry-save bitmap arithmetic, all of one weight at a time, into the slices of the score. The highest
rows are selected from the most significant slice downward, and rows that tie at the boundary are resolved
by id. Negative factors take the complement of a slice, so that every addend is positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingweave.llm.common import stored

#: Rows of an index block and queries of a query block.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 256
#: Components of so many bits or fewer go through the slices; sums stay far within 64 bits.
SLICED_BITS = 24


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Columns id, v (array of long): floor(scale * x), x as double. Unusable vectors are left out.

    Unusable: null, or with a component that is null, not finite, or beyond the long range once scaled.
    """
    scaled = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    fine = F.forall("s", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0**62)))
    return (
        vectors.select(F.col(id_col).alias("id"), scaled.alias("s"))
        .where(F.col("id").isNotNull() & F.col("s").isNotNull())
        .where(fine)
        .select("id", F.transform("s", lambda x: F.floor(x).cast("long")).alias("v"))
    )


class Index:
    """Bit slices of a block: attribute by digit by rows, packed eight rows to a byte."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        n, self.width = self.rows.shape
        self.low = int(self.rows.min(initial=0))
        top = int(self.rows.max(initial=0)) - self.low
        self.bits = max(1, top.bit_length())
        self.sliced = self.bits <= SLICED_BITS
        self.n = n
        if self.sliced:
            above = (self.rows - self.low).astype(np.uint32)
            packed = [
                np.packbits(((above >> np.uint32(d)) & np.uint32(1)).astype(np.uint8), axis=0, bitorder="little").T
                for d in range(self.bits)
            ]
            lanes = -(-n // 64) * 8
            slices = np.zeros((self.width, self.bits, lanes), np.uint8)
            slices[:, :, : packed[0].shape[1]] = np.stack(packed, axis=1)
            self.slices = slices.view(np.uint64)
            self.live = np.zeros(lanes, np.uint8)
            self.live[: -(-n // 8)] = np.packbits(np.ones(n, np.uint8), bitorder="little")
            self.live = self.live.view(np.uint64)

    def score_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """The slices of sum(|q| * s), least significant first; s is the row's offset value or its complement.

        For a row, the inner product is this sum plus a constant of the query, so the order is the same.
        """
        pending: dict[int, list[np.ndarray]] = {}
        for sign in (1, -1):
            chosen = np.flatnonzero(query * sign > 0)
            size = np.abs(query[chosen])
            for digit in range(int(size.max(initial=0)).bit_length()):
                dims = chosen[(size >> digit) & 1 == 1]
                if len(dims):
                    for d in range(self.bits):
                        part = self.slices[dims, d]
                        pending.setdefault(digit + d, []).append(part if sign > 0 else ~part)
        out: list[np.ndarray] = []
        weight = 0
        while pending:
            addends = pending.pop(weight, None)
            if addends is None:
                out.append(np.zeros_like(self.live))
            else:
                stack = np.concatenate(addends)
                carries: list[np.ndarray] = []
                while len(stack) > 1:
                    stack, carry = carry_save(stack)
                    carries.append(carry)
                out.append(stack[0])
                if carries:
                    pending.setdefault(weight + 1, []).extend(carries)
            weight += 1
        return out

    def top(self, query: np.ndarray, query_id: int, k: int) -> list[tuple[int, int]]:
        """The k best (id, score), ties to the smaller id; rows with the query's id take no part."""
        if not self.sliced or int(np.abs(query).max(initial=0)).bit_length() > SLICED_BITS:
            return self._plain(query, query_id, k)
        among = self.live.copy()
        own = np.arange(np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, "right"))
        np.bitwise_and.at(among, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
        sure = np.zeros_like(among)  # rows above all that are still in question
        missing = k
        for one in reversed(self.score_slices(query)):
            higher = among & one
            found = int(np.bitwise_count(higher).sum())
            if found >= missing:
                among = higher
            else:
                sure |= higher
                missing -= found
                among &= ~one
        tied = _rows(among)[:missing]  # equal in every slice: the smallest ids
        best = np.concatenate([_rows(sure), tied])
        score = self.rows[best] @ query
        order = np.lexsort((self.ids[best], -score))[:k]
        return [(int(self.ids[best[i]]), int(score[i])) for i in order]

    def _plain(self, query: np.ndarray, query_id: int, k: int) -> list[tuple[int, int]]:
        """For components that are too large to slice: exact integers."""
        q = [int(x) for x in query]
        scored = [
            (-sum(a * b for a, b in zip(q, map(int, row), strict=True)), int(i))
            for i, row in zip(self.ids, self.rows, strict=True)
            if i != query_id
        ]
        low, high = -(1 << 63), (1 << 63) - 1
        return [(i, min(high, max(low, -s))) for s, i in sorted(scored)[:k]]


def carry_save(stack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One layer of full adders (a half adder for two): bitmaps of the same weight, and carries of the next."""
    if len(stack) == 2:
        return (stack[0] ^ stack[1])[None], (stack[0] & stack[1])[None]
    third = len(stack) // 3
    a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
    half = a ^ b
    carry = a & b
    carry |= half & c
    half ^= c
    return np.concatenate([half, stack[3 * third :]]), carry


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _matrix(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _blocks(df: DataFrame, n: int) -> DataFrame:
    """Columns block (0 to ``n`` - 1), ids, width, v: rows dealt evenly, vectors as 16- or 64-bit numbers."""
    fields = {"block": pa.int32(), "ids": pa.binary(), "width": pa.int32(), "bytes": pa.int32(), "v": pa.binary()}

    def packed(block: int, ids: list, vectors: list) -> pa.RecordBatch:
        rows = _matrix(vectors, max(map(len, vectors)))
        if np.abs(rows).max(initial=0) < 1 << 15:
            rows = rows.astype(np.int16)
        values = [block, np.array(ids, np.int64).tobytes(), rows.shape[1], rows.itemsize, rows.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, fields.values(), strict=True)], names=list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors = None, [], []
        for b in batches:
            for block, i, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now and ids:
                    yield packed(now, ids, vectors)
                    ids, vectors = [], []
                now = block
                ids.append(i)
                vectors.append(v)
        if ids:
            yield packed(now, ids, vectors)

    # not by the id alone: one id may stand in very many rows
    dealt = df.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("block"), "id", "v")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "id")
    return dealt.mapInArrow(run, "block int, ids binary, width int, bytes int, v binary")


def _unpacked(ids: bytes, width: int, size: int, v: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(v, np.int16 if size == 2 else np.int64).reshape(-1, width) if width else np.zeros((len(ids) // 8, 0))
    return np.frombuffer(ids, np.int64), rows.astype(np.int64)


def top_products(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50,
    scale: int = 256, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES, at_once: int = 8,
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: for each id divisible by ``every`` its best ``k`` rows.

    Each block of queries meets each block of the index once; a task's key holds at most about ``at_once``
    such meetings, and each hands on ``k`` rows a query. Vectors that are null or hold null or non-finite
    components take no part, nor do null ids; shorter vectors count as filled up with zeros; a row never meets
    rows of its own id; repeated rows are candidates as often as they stand, and an id asks once (with its
    smallest vector). Scores beyond the long range stop at its ends.
    """
    usable = stored(quantised(vectors, id_col, vector_col, scale))
    asked = usable.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    cells = max(1, -(-usable.count() // block_rows))
    groups = max(1, -(-asked.count() // block_queries))
    salts = -(-groups // at_once)
    index = _blocks(usable, cells).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    queries = _blocks(asked, groups).select(
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("block"),
        (F.col("block") % salts).alias("salt"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "width", "bytes", "v")],
    )
    met = index.join(queries, ["block", "salt"]).select(
        "block", "ids", "width", "bytes", "v", "q_ids", "q_width", "q_bytes", "q_v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = (None, None)
        for b in batches:
            for block, ids, width, size, v, *query in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if built[0] != block:
                    built = (block, Index(*_unpacked(ids, width, size, v)))
                own = built[1]
                out: list[tuple[int, int, int]] = []
                for q, row in zip(*_unpacked(*query), strict=True):
                    fitted = np.zeros(own.width, np.int64)
                    fitted[: min(own.width, len(row))] = row[: own.width]
                    out += [(int(q), i, score) for i, score in own.top(fitted, int(q), k)]
                columns = zip(*out, strict=True) if out else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.mapInArrow(run, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
