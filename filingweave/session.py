"""Session settings every plan relies on, tables handed from job to job, and their folders."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key's join partition is split at run time, also when an aggregate follows the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a job shuffled goes with it; later jobs read what it stored.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on a scan of few splits; many splits are left as they are.

    Only for plain scans: asking a plan with shuffles for its partitions would run them.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def is_local(spark: SparkSession) -> bool:
    """One process on one machine: ``local`` or ``local[...]``, but not ``local-cluster[...]``."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch(spark: SparkSession) -> str:
    """A fresh folder name below the shared checkpoint folder, for tables handed from job to job."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="filingweave-")
    return f"{base.rstrip('/')}/filingweave-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write once into the shared folder and read back: computed once, where a checkpoint computes twice."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it does not exist."""
    place, system = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    place, system = _file_system(spark, path)
    system.delete(place, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for drivers that run outside its folder."""
    sc = spark.sparkContext
    if getattr(sc, "_filingweave_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="filingweave-ship-")) / "filingweave.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._filingweave_shipped = True
