"""Micro-batches of rows inside a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingweave.operators.ordered import group_key, numbered
from filingweave.session import stored


def fixed_batches(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int = 500,
    chunk: Column | None = None,
) -> DataFrame:
    """Add ``batch_no``: rows 0..size-1 of a group are batch 0, and so on."""
    rows = numbered(df, keys, order, chunk, name="_row_no")
    return rows.withColumn("batch_no", F.floor(F.col("_row_no") / size)).drop("_row_no")


def greedy_batches(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cost: Column,
    max_rows: int,
    max_cost: int = 50_000,
    chunk: Column | None = None,
    chunk_rows: int = 200_000,
) -> DataFrame:
    """Add ``batch_no``: a batch closes when it is full or the next row would take it over ``max_cost``.

    A batch's end depends on where it began, and from every row the next batch's start is known by a search
    in the running costs. Following these steps by doubling marks all starts at once. A group longer than
    ``chunk_rows`` is cut into parts: a batch open at a part's start must end within its first ``max_rows``
    rows, so each part can say beforehand how it ends for every one of these cases, and chaining these short
    answers gives each part its entry state. Python sees row numbers and costs only. A null cost counts as 0.
    """
    rows = stored(
        numbered(df, keys, order, chunk, name="_row_no").withColumns(
            {"_key": group_key(keys), "_part": F.floor(F.col("_row_no") / chunk_rows), "_cost": F.coalesce(cost.cast("long"), F.lit(0).cast("long"))}
        )
    )
    costs = _with_entries(rows.select("_key", "_part", "_row_no", "_cost"), max_rows, max_cost, chunk_rows)
    laid_out = costs.repartition("_key", "_part").sortWithinPartitions("_key", "_part", "_row_no")
    out = T.StructType([*[laid_out.schema[c] for c in ("_key", "_row_no")], T.StructField("batch_no", T.LongType())])
    numbers = laid_out.select("_key", "_row_no", "_cost", *_STATE).mapInArrow(_assign(chunk_rows, max_rows, max_cost), out)
    return rows.join(numbers, ["_key", "_row_no"]).select(*df.columns, "batch_no")


_STATE = ["_open_rows", "_open_cost", "_begun"]


def _with_entries(costs: DataFrame, max_rows: int, max_cost: int, chunk_rows: int) -> DataFrame:
    """Costs with the state of the open batch at their part's start; only groups of several parts need to look."""
    fresh = {n: F.lit(0).cast("long") for n in _STATE}
    long_groups = costs.where(F.col("_row_no") == chunk_rows).select("_key")
    if long_groups.isEmpty():
        return costs.withColumns(fresh)
    key = costs.schema["_key"].dataType.simpleString()
    longs = ", ".join(f"{n} array<bigint>" for n in ("sums", "end_rows", "end_cost", "begun"))
    answers = costs.join(long_groups, "_key", "left_semi").groupBy("_key", "_part").applyInArrow(
        _answers(max_rows, max_cost), f"_key {key}, _part bigint, {longs}"
    )
    states = answers.groupBy("_key").applyInArrow(
        _entries(max_rows, max_cost), f"_key {key}, _part bigint, {', '.join(f'{n} bigint' for n in _STATE)}"
    )
    return costs.join(states, ["_key", "_part"], "left").fillna(0, subset=_STATE)


def next_starts(sums: np.ndarray, ends: np.ndarray, max_rows: int, max_cost: int) -> np.ndarray:
    """Where the batch after one begun at each row begins; the number of rows where that is beyond the row's end.

    sums: costs before each row and in all. ends: where each row's part ends. The last entry stands for itself.
    """
    n = len(sums) - 1
    start = np.arange(n)
    fits = np.searchsorted(sums, sums[:-1] + max_cost, side="right") - 1
    following = np.minimum(np.maximum(fits, start + 1), start + max_rows)
    return np.append(np.where(following < ends, following, n), n)


def marked_starts(first: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which rows are reached from the ``first`` ones: with every round the steps known are twice as many."""
    n = len(following) - 1
    reached = np.zeros(n + 1, bool)
    reached[first] = True
    jump = following
    while (jump[:-1] < n).any():
        reached[jump[reached.nonzero()[0]]] = True
        jump = jump[jump]
    return reached[:n]


def _answers(max_rows: int, max_cost: int) -> Callable:
    """One row a part: running costs of its head and, for a batch begun at each head row, the end state."""

    def answer(part: pa.Table) -> pa.Table:
        costs = part.sort_by("_row_no")["_cost"].to_numpy()  # one part: at most chunk_rows numbers
        n = len(costs)
        sums = np.concatenate([[0], np.cumsum(costs)])
        jumps = [next_starts(sums, np.full(n, n), max_rows, max_cost)]
        while (jumps[-1][:-1] < n).any():
            jumps.append(jumps[-1][jumps[-1]])
        head = min(n, max_rows)
        last, begun = np.arange(head), np.ones(head, np.int64)
        for level in range(len(jumps) - 1, -1, -1):  # the farthest steps that stay inside come first
            further = jumps[level][last]
            inside = further < n
            last, begun = np.where(inside, further, last), begun + (inside.astype(np.int64) << level)
        lists = {"sums": sums[: head + 1], "end_rows": n - last, "end_cost": sums[-1] - sums[last], "begun": begun}
        one = part.select(["_key", "_part"]).slice(0, 1)
        for name, numbers in lists.items():
            one = one.append_column(name, pa.array([numbers.tolist()], pa.list_(pa.int64())))
        return one

    return answer


def _entries(max_rows: int, max_cost: int) -> Callable:
    """Chain the answers of one group's parts into the state each part is entered with."""

    def enter(group: pa.Table) -> pa.Table:
        group = group.sort_by("_part")
        open_rows = open_cost = begun = 0
        states = []
        for answer in group.select(["sums", "end_rows", "end_cost", "begun"]).to_pylist():
            states.append((open_rows, open_cost, begun))
            sums = np.array(answer["sums"], np.int64)
            head = np.arange(len(sums) - 1)
            closes = (open_rows + head >= max_rows) | (open_cost + sums[1:] > max_cost)
            if open_rows == 0:
                closes[0] = True
            if closes.any():
                p = int(closes.argmax())
                open_rows, open_cost = answer["end_rows"][p], answer["end_cost"][p]
                begun += answer["begun"][p]
            else:
                open_rows, open_cost = open_rows + len(head), open_cost + int(sums[-1])
        out = group.select(["_key", "_part"])
        for name, numbers in zip(_STATE, zip(*states, strict=True), strict=True):
            out = out.append_column(name, pa.array(numbers, pa.int64()))
        return out

    return enter


def batch_numbers(
    part_starts: np.ndarray, costs: np.ndarray, open_rows: np.ndarray, open_cost: np.ndarray, begun: np.ndarray, max_rows: int, max_cost: int
) -> np.ndarray:
    """Batch of each row of whole parts that lie one after another; the last three: each part's entry state."""
    n = len(costs)
    sums = np.concatenate([[0], np.cumsum(costs)])
    part_ends = np.append(part_starts[1:], n)
    lengths = part_ends - part_starts
    following = next_starts(sums, np.repeat(part_ends, lengths), max_rows, max_cost)
    full = part_starts + max_rows - open_rows
    dear = np.searchsorted(sums, sums[part_starts] + max_cost - open_cost, side="right") - 1
    first = np.where(open_rows == 0, part_starts, np.maximum(np.minimum(full, dear), part_starts))
    starts = marked_starts(first[first < part_ends], following)
    count = np.cumsum(starts)
    before = count[part_starts] - starts[part_starts]
    return count + np.repeat(begun - before, lengths) - 1


def _assign(chunk_rows: int, max_rows: int, max_cost: int) -> Callable:
    """Batches of sorted rows. A part begins at a row number divisible by ``chunk_rows``; it is settled as a whole."""

    def settled(rows: pa.Table) -> pa.RecordBatch:
        number, cost, *states = (rows[c].to_numpy() for c in ("_row_no", "_cost", *_STATE))
        starts = (number % chunk_rows == 0).nonzero()[0]
        batch = batch_numbers(starts, cost, *[s[starts] for s in states], max_rows, max_cost)
        return rows.select(["_key", "_row_no"]).append_column("batch_no", pa.array(batch, pa.int64()))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            starts = (b.column("_row_no").to_numpy() % chunk_rows == 0).nonzero()[0]
            if len(starts) and held:  # the last part that began is still open
                held.append(b.slice(0, starts[-1]))
                yield from settled(pa.Table.from_batches(held)).to_batches()
                held = [b.slice(starts[-1])]
            elif len(starts) > 1:
                yield from settled(pa.Table.from_batches([b.slice(0, starts[-1])])).to_batches()
                held = [b.slice(starts[-1])]
            else:
                held.append(b)
        if held and sum(map(len, held)):
            yield from settled(pa.Table.from_batches(held)).to_batches()

    return assign
