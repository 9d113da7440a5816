"""Operator 7: contiguous shards of nearly equal byte size.

Global prefix sums of the rows' sizes come from a running sum inside each partition plus the totals of the
partitions before it; cutting them at equal targets gives shards that are contiguous in the order of
(id, text checksum, size). DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingweave.llm.common import stored


def shard_by_bytes(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", row_bytes: int = 16
) -> DataFrame:
    """Columns: ``id_col``, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus ``row_bytes``. A row belongs to the shard in which its middle lies, so a
    shard differs from the target by less than one row at either end. slot: gapless from 0 inside the shard.

    Null texts count as empty (checksum 0); null ids come first; rows that are wholly alike are
    interchangeable; a row longer than a target leaves shards empty; no rows, no shards. Other columns of
    ``docs`` are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
        )
    )
    # The last key spreads rows that are wholly alike, so that many of them don't meet in one partition.
    order = [F.col("id").asc_nulls_first(), "crc", "size", "tie"]
    ranged = stored(
        narrow.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("ends", F.sum("size").over(upto))
        .withColumn("nth", F.row_number().over(inside))
        .join(offsets, "part")
        .select(
            "id", "size", "crc",
            F.expr(
                f"cast(least({shards - 1}, ((2 * (bytes_before + ends) - size) * {shards}) div (2 * total)) as int)"
            ).alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("nth"),
        )
    )
    placed = stored(placed)
    firsts = placed.groupBy("shard").agg(F.min("nth").alias("first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("nth") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
