"""Best earlier mark for each target, over two DataFrames of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingweave.operators.joins import split_join
from filingweave.operators.markup import best_hit


def keyword_hits(df: DataFrame, text: Column, keywords: Sequence[tuple[str, int]]) -> DataFrame:
    """One row for each keyword that occurs in the text: kw_idx, keyword, base_score.

    The keyword table is a constant of the query, so this is a map-only step.
    """
    marks = [
        F.when(
            F.contains(text, F.lit(word)),
            F.struct(
                F.lit(i).alias("kw_idx"), F.lit(word).alias("keyword"), F.lit(score).alias("base_score")
            ),
        )
        for i, (word, score) in enumerate(keywords)
    ]
    return df.select("*", F.explode(F.array_compact(F.array(*marks))).alias("_hit")).select(
        *df.columns, "_hit.*"
    )


def best_after(
    hits: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    levels: Sequence[tuple[int, int]],
    level: str = "level",
    pos: str = "pos",
    bonus: str = "bonus",
) -> DataFrame:
    """Per key, the target with the best (hit score + bonus) among targets after that hit.

    ``levels`` lists the (score, rank) of each hit level; ``level`` in ``hits`` is its index. Ties go to the
    lower rank, then the earlier hit, then the earlier target; negative scores do not count. No pair is ever
    listed: hits shrink on the map side to the first position of each level, and each target looks at those.
    """
    firsts = hits.groupBy(*keys).agg(
        *[F.min(F.when(F.col(level) == i, F.col(pos))).alias(f"_l{i}") for i in range(len(levels))]
    )
    joined = split_join(targets, firsts, keys)
    best = best_hit([F.col(f"_l{i}") for i in range(len(levels))], levels, F.col(pos))
    scored = joined.select(*keys, pos, bonus, best.alias("_hit")).where(
        F.col("_hit.score") + F.col(bonus) >= 0
    )
    order = F.struct(
        (F.col("_hit.score") + F.col(bonus)).alias("score"),
        F.col("_hit.rank").alias("rank"),
        F.col("_hit.hit").alias("hit"),
        (-F.col(pos)).alias("pos"),
    )
    return (
        scored.groupBy(*keys)
        .agg(F.max(order).alias("_b"))
        .select(
            *keys,
            F.col("_b.score").alias("score"),
            (-F.col("_b.rank")).alias("rank"),
            (-F.col("_b.hit")).alias("hit_pos"),
            (-F.col("_b.pos")).alias("target_pos"),
        )
    )
