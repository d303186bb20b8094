"""Arrays in one file that Spark brings to every executor and workers map into memory."""

from __future__ import annotations

import fcntl
import json
import os
from contextlib import ExitStack

import numpy as np
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from jangbu.session import scratch_path

_WRITE = 32 << 20


def shared_file(spark: SparkSession, content: bytes, label: str) -> str:
    """Write `content` to the shared scratch folder and have Spark bring it to every executor; its name there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    for start in range(0, len(content), _WRITE):
        out.write(content[start : start + _WRITE])
    out.close()
    spark.sparkContext.addFile(target.toString())
    return target.getName()


def array_file(arrays: list[np.ndarray]) -> bytes:
    """The arrays one after the other, behind a line that tells their types and sizes."""
    out = bytearray(json.dumps([[a.dtype.str, a.nbytes] for a in arrays]).encode() + b"\n")
    for a in arrays:
        out += bytes(-len(out) % 8) + a.tobytes()
    return bytes(out)


def mapped_arrays(file: str) -> list[np.ndarray]:
    """The arrays of such a file, mapped and not read."""
    with open(file, "rb") as f:
        head = json.loads(f.readline())
        start = f.tell()
    mapped = np.memmap(file, np.uint8, "r")
    out = []
    for kind, size in head:
        start += -start % 8
        out.append(mapped[start : start + size].view(kind))
        start += size
    return out


def shared_parts(spark: SparkSession, path: str) -> list[str]:
    """Have Spark bring the Parquet files of a stored table to every executor; their names there, in the table's order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    files = {f.getPath().getName(): f.getPath().toString() for f in found if f.getPath().getName().startswith("part-")}
    for name in sorted(files):
        spark.sparkContext.addFile(files[name])
    return sorted(files)


def mapped_parts(files: list[str], kinds: dict[str, type]) -> list[np.ndarray]:
    """The columns of such files as mapped arrays. The first worker of an executor unpacks them, a batch at a time, while
    others wait, and removes what it has unpacked; a new executor gets the files anew."""
    if not files:
        return [np.zeros(0, kind) for kind in kinds.values()]
    target = os.path.join(SparkFiles.getRootDirectory(), files[0])
    with open(f"{target}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(f"{target}.done"):
            with ExitStack() as stack:
                out = {c: stack.enter_context(open(f"{target}.{c}", "wb")) for c in kinds}
                for name in files:
                    for batch in pq.ParquetFile(SparkFiles.get(name)).iter_batches(columns=list(kinds)):
                        for column, kind in kinds.items():
                            out[column].write(batch.column(column).to_numpy().astype(kind).tobytes())
            open(f"{target}.done", "w").close()
            for name in files:
                os.remove(SparkFiles.get(name))
    paths = [f"{target}.{c}" for c in kinds]
    return [np.memmap(p, kind, "r") if os.path.getsize(p) else np.zeros(0, kind) for p, kind in zip(paths, kinds.values())]
