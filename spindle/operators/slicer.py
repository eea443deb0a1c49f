"""Deep slices: every combination of dimensions within a depth, in one grouped pass."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F


#: How cells of a finer grain add up to cells of a coarser one.
ADDS_UP = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
PLAIN = re.compile(r"\s*(count|sum|min|max)\s*\((?!\s*distinct\b)[^()]*\)\s*", re.IGNORECASE)


def _grouped(df: DataFrame, dims: Sequence[str], sets: list[tuple[str, ...]]) -> GroupedData:
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims])


def cells(
    df: DataFrame, dims: Sequence[str], low: int = 2, high: int = 4, least: int = 1, metric: str | Column = "count(1)"
) -> DataFrame:
    """All cells of all combinations of ``low`` to ``high`` dimensions: the dimensions,
    ``combination``, ``depth``, ``cell_count``.

    One GROUPING SETS query reads the data once; counts, sums, smallest and largest values are
    taken over the finest cells first.  Cells with a null in a dimension of
    their combination are dropped, which equals dropping those rows beforehand; so are
    cells below ``least``."""
    high = min(high, len(dims))
    sets = [s for d in range(low, high + 1) for s in combinations(dims, d)]
    if not sets:
        raise ValueError(f"no combination of {low} to {high} of {len(dims)} dimensions")
    if isinstance(metric, str) and (plain := PLAIN.fullmatch(metric)):
        # Combinations multiply the finest cells then, not the rows.
        df = df.groupBy(*dims).agg(F.expr(metric).alias("_m"))
        metric = F.expr(f"{ADDS_UP[plain[1].lower()]}(_m)")
    metric = F.expr(metric) if isinstance(metric, str) else metric
    out = _grouped(df, dims, sets).agg(metric.alias("cell_count"), *[F.grouping(c).alias(f"_g{i}") for i, c in enumerate(dims)])
    used = [F.when(F.col(f"_g{i}") == 0, F.lit(c)) for i, c in enumerate(dims)]
    for i, c in enumerate(dims):
        out = out.where((F.col(f"_g{i}") == 1) | F.col(c).isNotNull())
    out = out.where(F.col("cell_count") >= least)
    depth = sum((1 - F.col(f"_g{i}").cast("int") for i in range(len(dims))), F.lit(0))
    return out.select(*dims, F.concat_ws(",", *used).alias("combination"), depth.cast("int").alias("depth"), "cell_count")


def deep_slices(
    df: DataFrame, dims: Sequence[str], low: int = 2, high: int = 4, least: int = 1, metric: str | Column = "count(1)"
) -> DataFrame:
    """One row per combination with any cell, the deepest and then the fullest first:
    cells, total volume, smallest, largest and mean cell."""
    n = F.col("cell_count")
    out = cells(df, dims, low, high, least, metric).groupBy("combination", "depth").agg(
        F.count(F.lit(1)).alias("non_empty_cells"), F.sum(n).alias("total_volume"),
        F.min(n).alias("min_cell_size"), F.max(n).alias("max_cell_size"), F.avg(n).alias("avg_cell_size"),
    )
    return out.orderBy(F.desc("depth"), F.desc("non_empty_cells"), "combination")


def preview(df: DataFrame, combination: Sequence[str], k: int = 10, least: int = 1, metric: str | Column = "count(1)") -> DataFrame:
    """The ``k`` largest cells of one combination."""
    own = cells(df, combination, len(combination), len(combination), least, metric).drop("combination", "depth")
    return own.orderBy(F.desc("cell_count"), *combination).limit(k)
