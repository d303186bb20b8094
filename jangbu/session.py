"""Spark session for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def local_session(cpus: int | str = "*", app: str = "jangbu", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Joins whose measured partitions are small are hashed instead of sorted.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: `spark.checkpoint.dir`, which every executor can read.

    Only a local master may fall back to a folder of this machine.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="jangbu-")
    return _local_scratch


_open: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside when the block ends.

    Results are lazy and read these tables: write or collect them before the end.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the scratch folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the chain), computes a
    table used several times only once, and gives the planner its true size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
