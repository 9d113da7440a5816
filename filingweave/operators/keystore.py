"""Keys that are done, kept in buckets on disk, so that an increment shuffles its own keys only."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from filingweave.operators.joins import split_join
from filingweave.session import discard, folders
from filingweave.sources.tables import batch_name


class KeyStore:
    """Distinct keys by increment, each increment in ``buckets`` sorted files by the keys' hash.

    The number of buckets is settled when the store is made and is part of its path. Rows of an increment
    that runs again replace its keys. Keys with a null in them are not kept: they match nothing.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], types: Sequence[str], buckets: int | None = None):
        self.spark, self.keys, self.types = spark, list(keys), list(types)
        made = [m for m in (re.fullmatch(r"into-(\d+)", name) for name in folders(spark, path)) if m]
        self.buckets = int(made[0][1]) if made else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = f"{path.rstrip('/')}/into-{self.buckets}"
        self.name = None
        self._open()

    def _open(self) -> None:
        """The session's name for the folder. Nothing but the folder outlives the session."""
        self.close()
        self.name = f"filingweave_keys_{uuid.uuid4().hex}"
        columns = ", ".join(f"{k} {t}" for k, t in zip(self.keys, self.types, strict=True))
        by = ", ".join(self.keys)
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}, batch STRING) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if self.batches():
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def close(self) -> None:
        """Give the session's name up. Data frames made from the store must have been used by then."""
        if self.name:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.name = None

    def batches(self) -> set[str]:
        return {name.removeprefix("batch=") for name in folders(self.spark, self.path) if name.startswith("batch=")}

    def put(self, rows: DataFrame, batch: str) -> None:
        """The keys of an increment, named as its directory is (``b-1``)."""
        keys = rows.select(*self.keys).dropna().distinct().repartition(self.buckets, *self.keys)
        view = f"{self.name}_new"
        keys.createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{batch}') SELECT {', '.join(self.keys)} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def follow(self, path: str, read: Callable[[str], DataFrame], batch: str) -> None:
        """Take in the increments of the table at ``path`` that are not here yet, but not the one being made.

        Each is read once, by ``read(directory)``, however many there are. The one being made is forgotten.
        """
        current = batch_name(batch)
        there = {name.removeprefix("batch=") for name in folders(self.spark, path) if name.startswith("batch=")} - {current}
        stale = self.batches() - there
        for old in stale:
            discard(self.spark, f"{self.path}/batch={old}")
        if stale:
            self._open()
        for new in sorted(there - self.batches()):
            self.put(read(f"{path.rstrip('/')}/batch={new}"), new)

    def found(self, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` that are done. The store is read as it lies: only the rows' keys move."""
        asked = rows.select(*self.keys).dropna().distinct().repartition(self.buckets, *self.keys)
        return self.spark.table(self.name).join(asked, self.keys, "left_semi").select(*self.keys).distinct()


def pending_of(rows: DataFrame, stores: Sequence[KeyStore]) -> DataFrame:
    """Rows whose key is in none of the stores. A key that many rows have is split by the join."""
    for store in stores:
        rows = split_join(rows, store.found(rows), store.keys, "left_anti")
    return rows
