"""Dimension rows (first value wins, gaps are filled) and fact rows (duplicates fold)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.plans.spec import SOURCE_ID, SOURCE_ROW


def first_values(df: DataFrame, key: str, order: str = SOURCE_ROW, keep_order: bool = False) -> DataFrame:
    """One row per non-null ``key``: of every other column the first non-null value by
    ``order``, in one grouped pass."""
    others = [c for c in df.columns if c not in (key, order)]
    firsts = [F.expr(f"min_by(`{c}`, `{order}`) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in others]
    kept = [F.min(order).alias(order)] if keep_order else []
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*firsts, *kept) if firsts or kept else df.select(key).where(F.col(key).isNotNull()).distinct()


def merge_dimension(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All keys of both sides; what ``old`` has stays, its nulls are filled from ``new``.
    Columns that only one side has are null on the other (the stored table grows).  A row
    keeps the source that brought it first."""
    columns = list(dict.fromkeys([*old.columns, *new.columns]))
    a, b = old.alias("a"), new.alias("b")

    def pick(c: str):
        sides = [F.col(f"{s}.`{c}`") for s, df in (("a", old), ("b", new)) if c in df.columns]
        if c == SOURCE_ID and len(sides) == 2:
            return F.when(F.col(f"a.`{key}`").isNotNull(), sides[0]).otherwise(sides[1]).alias(c)
        return F.coalesce(*sides).alias(c)

    return a.join(b, F.col(f"a.`{key}`") == F.col(f"b.`{key}`"), "full_outer").select(*map(pick, columns))


def fold_facts(df: DataFrame, order: str = SOURCE_ROW) -> DataFrame:
    """One row for each distinct content (nulls equal), with the smallest row number."""
    content = [c for c in df.columns if c != order]
    return df.groupBy(*content).agg(F.min(order).alias(order))


def difference_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """``mismatches``: the size of both multiset differences together, in one shuffle:
    rows of ``a`` weigh 1, of ``b`` -1, equal rows cancel."""
    columns = a.columns
    both = a.withColumn("_w", F.lit(1)).unionByName(b.select(*columns).withColumn("_w", F.lit(-1)))
    left = both.groupBy(*columns).agg(F.sum("_w").alias("_w"))
    return left.agg(F.coalesce(F.sum(F.abs("_w")), F.lit(0)).cast("long").alias("mismatches"))
