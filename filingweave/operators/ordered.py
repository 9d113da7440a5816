"""Order-dependent work inside groups of any size.

A plain window would put a whole group into one task. Here a group is cut into chunks along its order; each
chunk is worked on alone and only one small summary row a chunk meets the rest of its group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingweave.session import stored


def with_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column | None = None, chunk_rows: int = 1_000_000
) -> DataFrame:
    """Add ``_chunk``, which never falls along the order of a group and belongs to some ``chunk_rows`` rows at most.

    Pass ``chunk`` when one is known (such as a day number of the ordering timestamp). A chunk with more rows
    is range-split by the order again, ties too, and only its rows move for that. Without ``chunk`` all rows are
    range-partitioned. What is split by ranges is stored, so that every later read sees the same cuts, also
    after a lost executor.
    """
    if chunk is None:
        return stored(df.repartitionByRange(*keys, *order).withColumn("_chunk", F.spark_partition_id()))
    marked = df.withColumns({"_group": group_key(keys), "_known": chunk})
    by_chunk = ["_group", "_known"]
    crowded = marked.groupBy(*by_chunk).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > chunk_rows)
    crowded = stored(crowded)  # a row for ``chunk_rows`` rows at most; Spark broadcasts it by its size
    total = crowded.agg(F.sum("_rows")).first()[0]
    if not total:
        return marked.withColumn("_chunk", F.struct("_known", F.lit(0).alias("_part"))).drop(*by_chunk)
    same = [F.col("_group") == F.col("_crowded._group"), F.col("_known").eqNullSafe(F.col("_crowded._known"))]
    crowded = crowded.select(F.struct(*by_chunk).alias("_crowded"))
    parts = -(-2 * total // chunk_rows) + 1
    split = marked.join(crowded, same, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    split = split.repartitionByRange(parts, *by_chunk, *order, "_tie").withColumn("_part", F.spark_partition_id())
    whole = marked.join(crowded, same, "left_anti").withColumn("_part", F.lit(0))
    both = whole.unionByName(stored(split.drop("_tie")))
    return both.withColumn("_chunk", F.struct("_known", "_part")).drop(*by_chunk, "_part")


def group_key(keys: Sequence[str]) -> Column:
    """The keys as one struct: unlike bare columns, structs with nulls inside are equal in a join too."""
    return F.struct(*keys)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column | None = None,
    name: str = "row_no",
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Row number from 0 within the group, as a window's row_number() - 1 would give it, for groups of any size."""
    chunked = with_chunks(df, keys, order, chunk, chunk_rows).withColumn("_key", group_key(keys))
    by_chunk = ["_key", "_chunk"]
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*by_chunk)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*by_chunk, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy(*by_chunk).orderBy(*order)) - 1
    return (
        chunked.withColumn("_local", local)
        .join(offsets, by_chunk)
        .withColumn(name, F.col("_before") + F.col("_local"))
        .select(*df.columns, name)
    )


def count_later_pairs(
    df: DataFrame, keys: Sequence[str], pos: str, earlier: Column, later: Column, chunk: Column, chunk_rows: int = 1_000_000
) -> DataFrame:
    """Per key, the number of (earlier, later) row pairs with pos(earlier) < pos(later).

    Counted, never listed: pairs inside a chunk from a running count, pairs across chunks as a product.
    """
    marked = df.select(
        *keys,
        pos,
        chunk.alias("_by"),
        earlier.cast("long").alias("_earlier"),
        later.cast("long").alias("_later"),
    ).where("_earlier = 1 or _later = 1")
    marked = with_chunks(marked, keys, [pos, "_earlier"], F.col("_by"), chunk_rows)
    # at equal positions the later-side row comes first, so that it does not count its equals
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(pos, "_earlier")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        marked.withColumn("_seen", F.coalesce(F.sum("_earlier").over(inside), F.lit(0)))
        .groupBy(*keys, "_chunk")
        .agg(
            F.sum(F.col("_seen") * F.col("_later")).alias("_inside"),
            F.sum("_earlier").alias("_earlier"),
            F.sum("_later").alias("_later"),
        )
        .withColumn("_carried", F.coalesce(F.sum("_earlier").over(before), F.lit(0)))
    )
    return chunks.groupBy(*keys).agg(
        F.sum(F.col("_inside") + F.col("_carried") * F.col("_later")).alias("n_pairs")
    )
