"""Facts that arrive as a stream of files, merged batch by batch.

The batch rules hold: a batch's rows are folded, and what is stored already is left
out, so a replayed batch (exactly what a restarted stream may deliver) changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spindle.operators.merge import first_values, merge_dimension
from spindle.sources.storage import Store


def read_files(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """A stream of the files that appear in a folder."""
    reader = spark.readStream.schema(schema).format(kind)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(folder)


def append_new(stream: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Appends each batch's rows whose keys are not stored yet, one row per key: the first
    in the order of the other columns' values."""

    def write(batch: DataFrame, number: int) -> None:
        others = [c for c in batch.columns if c not in keys]
        new = batch.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*") if others else batch.distinct()
        new = new.select(*batch.columns)
        if Store(batch.sparkSession).children(path):  # the first batch finds no table
            new = new.join(batch.sparkSession.read.schema(batch.schema).parquet(path).select(*keys), keys, "left_anti")
        new.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_into(stream: DataFrame, path: str, key: str, checkpoint: str, order: str | None = None) -> StreamingQuery:
    """Merges each batch into a dimension: new keys come in, gaps are filled.

    Batch n writes ``<path>/v<n>`` from ``v<n - 1>``, so a replayed batch writes the same
    version again; versions before the last two are removed.  Of several values in a batch the
    first by ``order`` counts, else the smallest."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if order:
            new = first_values(batch, key, order)
        else:
            values = [c for c in batch.columns if c != key]
            new = batch.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(c) for c in values])
        if number:
            new = merge_dimension(spark.read.parquet(f"{path}/v{number - 1}"), new, key)
        new.write.mode("overwrite").parquet(f"{path}/v{number}")
        if number > 1:
            Store(spark).remove(f"{path}/v{number - 2}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time_col: str, width: str, by: list[str], late: str = "1 hour") -> DataFrame:
    """Rows per time window and group, rows later than ``late`` left out."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, width).alias("window"), *by).agg(F.count(F.lit(1)).alias("n"))
