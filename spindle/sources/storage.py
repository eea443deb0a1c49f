"""Files and tables in any store that Spark reaches, through Hadoop's file system."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Store:
    """Small files of one session's stores.  A new file appears whole or not at all."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def is_file(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at) and fs.getFileStatus(at).isFile()

    def children(self, path: str) -> list[str]:
        """Names in a folder, sorted; none where there is no folder."""
        at, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def read(self, path: str) -> str:
        at, fs = self._at(path)
        stream = fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file; an existing one raises."""
        at, fs = self._at(path)
        held = self._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid.uuid4().hex}")
        stream = fs.create(held, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if fs.exists(at) or not fs.rename(held, at):
            fs.delete(held, False)
            raise FileExistsError(path)

    def remove(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)

    def sha256(self, path: str) -> str:
        """Digest of a file of any size, read as a stream."""
        at, fs = self._at(path)
        digest = self._jvm.java.security.MessageDigest.getInstance("SHA-256")
        stream = self._jvm.java.security.DigestInputStream(fs.open(at), digest)
        self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, self._jvm.java.io.OutputStream.nullOutputStream(), 1 << 20, True)
        return bytes(digest.digest()).hex()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a folder of its own only in a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spindle-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, so that all its readers see one
    result even if an executor is lost.  The table goes when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
