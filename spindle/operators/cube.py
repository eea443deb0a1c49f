"""OLAP operations: slice and dice, roll-up, cube, pivot; small cells can be hidden."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.sources.storage import materialize

Measures = Mapping[str, str | Column]
MOST_COLUMNS = 10_000  # of a pivot, as many as Spark's own takes


@dataclass(frozen=True)
class Join:
    """A join that the caller gives: the other table, the condition over both sides' columns
    as SQL text, and the kind."""

    table: DataFrame
    on: str
    how: str = "inner"


def with_joins(df: DataFrame, joins: Sequence[Join]) -> DataFrame:
    """``df`` with the given joins, one after the other."""
    for j in joins:
        df = df.join(j.table, F.expr(j.on), j.how)
    return df


def where_all(df: DataFrame, filters: Mapping[str, Any] | None) -> DataFrame:
    """Rows that satisfy all filters: a list or tuple means one of, None means null."""
    for name, wanted in (filters or {}).items():
        own = F.col(name)
        if isinstance(wanted, (list, tuple, set)):
            df = df.where(own.isin(*wanted))
        else:
            df = df.where(own.isNull() if wanted is None else own == F.lit(wanted))
    return df


def _measures(measures: Measures) -> list[Column]:
    return [(F.expr(m) if isinstance(m, str) else m).alias(name) for name, m in measures.items()]


def _large(df: DataFrame, least: int) -> DataFrame:
    return df.where(F.col("_cell") >= least).drop("_cell") if least else df


def _cell(least: int) -> list[Column]:
    return [F.count(F.lit(1)).alias("_cell")] if least else []


def slice_and_dice(
    df: DataFrame, measures: Measures, by: Sequence[str] = (), filters: Mapping[str, Any] | None = None, least: int = 0
) -> DataFrame:
    """Measures by dimensions after filters, in order of the dimensions, nulls last.
    Without dimensions: one row of totals.  ``least``: hide cells of fewer rows."""
    out = where_all(df, filters).groupBy(*by).agg(*_measures(measures), *_cell(least))
    out = _large(out, least)
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in by]) if by else out


def rollup(df: DataFrame, levels: Sequence[str], measure: str | Column = "count(1)", least: int = 0, full: bool = False) -> DataFrame:
    """``measure_val`` for every level of the hierarchy and the grand total;
    ``grouping_id`` tells a subtotal from a null level.  ``full``: all combinations."""
    grouped = df.cube(*levels) if full else df.rollup(*levels)
    out = grouped.agg(*_measures({"measure_val": measure}), F.grouping_id().alias("grouping_id"), *_cell(least))
    return _large(out, least).orderBy(*[F.col(c).asc_nulls_last() for c in levels], "grouping_id")


def pivot_name(value: Any, suffix: str = "count") -> str:
    """Column name of a pivoted value."""
    return re.sub(r"[ -]", "_", str(value)).lower() + f"_{suffix}"


def pivot(
    df: DataFrame, row: str, column: str, measure: str | None = None, values: Sequence[Any] | None = None, suffix: str = "count",
    most: int = MOST_COLUMNS,
) -> DataFrame:
    """One row per ``row`` value, one column per ``column`` value; counts by default, with
    0 for absent cells.

    The table is aggregated to its cells once.  Without ``values`` the distinct ones are read
    from the cells; more than ``most`` of them are refused, as each becomes a column."""
    cells = df.groupBy(row, column).agg(F.expr(measure or "count(1)").alias("_v"))
    if values is None:
        cells = materialize(cells, "cells")
        found = cells.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1)
        values = [r[0] for r in found.collect()]  # at most ``most`` + 1
        if len(values) > most:
            raise ValueError(f"{column} has more than {most} values; name the wanted ones")
    own = [F.first(F.when(F.col(column) == F.lit(v), F.col("_v")), ignorenulls=True).alias(pivot_name(v, suffix)) for v in values]
    return cells.groupBy(row).agg(*own).fillna(0).orderBy(F.col(row).asc_nulls_last())


def fan_out_safe_total(df: DataFrame, grain: Sequence[str], measure: str, name: str = "total") -> DataFrame:
    """The total of a measure that a join may have repeated: one value per grain."""
    return df.select(*grain, measure).distinct().agg(F.sum(measure).alias(name))


def share_of_group(df: DataFrame, group: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Each row's part of its group's total; groups are those of an aggregate."""
    from pyspark.sql import Window

    return df.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*group)))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows, values, smallest, largest and mean of a numeric column."""
    own = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(own).alias("n"), F.min(own).alias("low"), F.max(own).alias("high"),
        F.avg(own.cast("decimal(18,4)")).cast("double").alias("mean"),
    )


def compare_groups(expected: DataFrame, actual: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Groups whose value differs or that only one side has (null keys are equal)."""
    a, b = expected.alias("a"), actual.alias("b")
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`"))
    rows = a.join(b, same, "full_outer")
    keys = [F.coalesce(F.col(f"a.`{c}`"), F.col(f"b.`{c}`")).alias(c) for c in by]
    rows = rows.select(*keys, F.col(f"a.`{value}`").alias("expected"), F.col(f"b.`{value}`").alias("actual"))
    return rows.where(~F.col("expected").eqNullSafe(F.col("actual")))
