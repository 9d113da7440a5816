"""A grouped pick over an incremental table, kept as a table and brought up to date from the increments alone."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.operators.grouped import others
from filingweave.session import discard, folders


def counted_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows with a count ``n``, the first of every key in the given order, and the key's whole count."""
    rest = others(rows, [*keys, "n"])
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_pick"), F.sum("n").alias("n"))
    return picked.select(*keys, "_pick.*", "n").select(*rows.columns)


class FoldedTable:
    """``fold`` of what ``read`` gives for all increments of a table, stored below ``path``.

    ``fold`` keeps the columns, and folding folded rows with others must be the same as folding all rows at
    once. A version lists the increments in it, each with a stamp of its files, and counts only once that list
    is there, so a run that breaks off leaves the version before. An increment that was written again or taken
    away cannot be taken out of a fold: then, and only then, all increments are folded anew.
    """

    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.fold = spark, path.rstrip("/"), fold
        self.folded: list[str] = []  #: increments that the last ``follow`` read

    def _stamps(self, table: str) -> dict[str, str]:
        batches = [name for name in folders(self.spark, table) if name.startswith("batch=")]
        names = {b: sorted(folders(self.spark, f"{table}/{b}")) for b in batches}
        return {b: hashlib.sha256("\n".join(files).encode()).hexdigest() for b, files in names.items()}

    def _versions(self) -> list[int]:
        return sorted(int(name.removeprefix("v-")) for name in folders(self.spark, self.path) if name.startswith("v-"))

    def _whole(self, version: int) -> bool:
        return "_SUCCESS" in folders(self.spark, f"{self.path}/v-{version}/increments")

    def follow(self, table: str, read: Callable[[list[str]], DataFrame]) -> DataFrame:
        """The fold of all increments of ``table``; ``read`` gives the rows of some of its directories."""
        table, versions = table.rstrip("/"), self._versions()
        whole = [v for v in versions if self._whole(v)]
        there, known = self._stamps(table), {}
        if whole:
            at = f"{self.path}/v-{whole[-1]}"
            known = {r.batch: r.stamp for r in self.spark.read.schema("batch string, stamp string").parquet(f"{at}/increments").collect()}
            if not all(there.get(b) == stamp for b, stamp in known.items()):
                known = {}
        self.folded = sorted(set(there) - set(known))
        rows = read([f"{table}/{b}" for b in self.folded])
        if known:
            state = self.spark.read.schema(rows.schema).parquet(f"{at}/rows")
            if not self.folded:
                return state
            rows = state.unionByName(rows)
        elif not there:
            return rows
        new = f"{self.path}/v-{max(versions, default=0) + 1}"
        self.fold(rows).hint("rebalance").write.parquet(f"{new}/rows")
        stamps = self.spark.createDataFrame(sorted(there.items()), "batch string, stamp string")
        stamps.coalesce(1).write.parquet(f"{new}/increments")
        for old in versions:  # the version before stays for readers that have begun
            if old not in whole[-1:]:
                discard(self.spark, f"{self.path}/v-{old}")
        return self.spark.read.schema(rows.schema).parquet(f"{new}/rows")
