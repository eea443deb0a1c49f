"""Generated keys: stable, readable, numbered by first appearance."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.sources.storage import materialize

KEYMAP = "dimension string, natural_key string, surrogate_key string, source_id string"


def key_prefix(dimension: str) -> str:
    """Three letters of a dimension's name without its ``dim_``: PAT for dim_patient."""
    name = re.sub(r"[^A-Z0-9]", "", re.sub(r"^dim_", "", dimension).upper())
    return name[:3] or "KEY"


def numbered(df: DataFrame, order: list[str], name: str = "n", start: int = 0) -> DataFrame:
    """Adds a number from ``start`` + 1 without gaps, in total order of ``order``.

    Rows are range-partitioned by the order, sorted within partitions, and written once with
    partition and place; the places are shifted by the sizes of the partitions before.  So no
    task gets all rows, and a lost executor cannot move a number."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return without_gaps(materialize(placed_rows(placed), "numbered"), name, start)


def placed_rows(df: DataFrame) -> DataFrame:
    """Adds ``_at``: the number of a row's partition above 33 bits of its place in it."""
    return df.withColumn("_at", F.monotonically_increasing_id())


def without_gaps(placed: DataFrame, name: str, start: int = 0) -> DataFrame:
    """``_at`` of a written table as a number from ``start`` + 1 without gaps.  The sizes of the
    partitions, one row each, are counted from that column alone and broadcast."""
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    joined = placed.withColumn("_part", part).join(F.broadcast(shifts), "_part")
    return joined.withColumn(name, F.col("_shift") + place + F.lit(start + 1)).drop("_part", "_at", "_shift")


def numbered_as_read(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Adds a number from ``start`` + 1 without gaps, in the order of the input's partitions
    and rows, without a sort."""
    return without_gaps(materialize(placed_rows(df), "read"), name, start)


def empty_keymap(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], KEYMAP)


def new_keys(naturals: DataFrame, keymap: DataFrame, dimension: str, source_id: str) -> DataFrame:
    """Key map rows for the natural keys that ``keymap`` does not hold yet.

    ``naturals(natural_key, first_row)``: one row per key or more.  Numbers go on after
    those the dimension has; past 999,999 they grow a digit."""
    known = keymap.where(F.col("dimension") == dimension)
    have = known.count()
    first = naturals.where("natural_key is not null").groupBy("natural_key").agg(F.min("first_row").alias("first_row"))
    fresh = first.join(known.select("natural_key"), "natural_key", "left_anti")
    rows = numbered(fresh, ["first_row", "natural_key"], start=have)
    key = F.format_string(f"{key_prefix(dimension)}-%06d", "n")
    return rows.select(F.lit(dimension).alias("dimension"), "natural_key", key.alias("surrogate_key"), F.lit(source_id).alias("source_id"))


def with_surrogate(df: DataFrame, keymap: DataFrame, dimension: str, column: str, natural: str | None = None) -> DataFrame:
    """``df`` with the natural key in ``column`` replaced by the generated one; ``natural``
    names a further column that keeps the natural key as text."""
    at = natural or "_natural"
    own = keymap.where(F.col("dimension") == dimension).select(F.col("natural_key").alias("_nk"), F.col("surrogate_key").alias("_sk"))
    joined = df.withColumn(at, df[column].cast("string")).join(own, F.col(at) == F.col("_nk"), "left").drop("_nk", column)
    return joined.withColumnRenamed("_sk", column).select(*df.columns, *([at] if natural else []))
