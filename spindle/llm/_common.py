"""Shared helpers: the cluster's shared folder, tables that cut lineage, batches."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a folder of its own only where
    none is set in a local session, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spindle-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def importable(spark: SparkSession) -> None:
    """Lets Python workers of a local session that was started elsewhere find this package
    where the driver found it; a cluster ships it with --py-files."""
    if not spark.sparkContext.master.startswith("local"):
        return
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: the lineage is cut, and
    a lost executor costs no recomputation.  The table goes when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small driver-side file (a vocabulary), local or in any store that Spark reads."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


#: Bytes of a batch that is passed to or from Python workers, about (one row may be longer).
BATCH = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches to ``BATCH`` bytes, if they may be larger: the JVM and
    the worker of each running task hold some of them at one time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = (spark.conf.get(name, None) or "").rstrip("b")
    if not (now.isdigit() and int(now) <= BATCH):
        spark.conf.set(name, str(BATCH))


#: Characters of texts that are Python strings at one time, about (one text may be longer).
SLICE = 400_000
#: Rows of one or two numbers that are broadcast at most, 16 MB; larger tables are shuffled.
SMALL = 1_000_000


def slices(batch: pa.RecordBatch, index: int, most: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """The texts of a column in runs of about ``most`` bytes, each with its first row, so that
    a batch is never a list of strings as a whole.  Null counts as empty."""
    column = batch.column(index)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield begin, [t or "" for t in column.slice(begin, i - begin).to_pylist()]
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, [t or "" for t in column.slice(begin).to_pylist()]


@functools.lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not glibc
        return None


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after which the worker gives freed memory back to the system: workers live on
    from task to task, and what one stage needed would add to what the next one needs."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if _trim():
                _trim()(0)

    return wrapped


def small(df: DataFrame) -> DataFrame:
    """A written table of numbers, to be broadcast if it has at most ``SMALL`` rows."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df
