"""Aggregate-only profiles: no value of a row appears unless enough rows share it."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.types import DAY, INSTANT, REAL, TEXT, WHOLE, type_of

STATS = "variable string, type string, rows long, nulls long, null_pct double, n_distinct long, low string, high string, mean double, min_length int, max_length int"


def column_stats(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per column: rows, nulls, distinct values, bounds, mean or text lengths.

    One pass for all columns.  ``exact=False`` counts distinct values by sketch, which
    needs no shuffle of the values and is the choice for very large tables."""
    columns = columns or df.columns
    count = F.count_distinct if exact else F.approx_count_distinct
    aggs: list[Column] = []
    for i, c in enumerate(columns):
        own, kind = F.col(f"`{c}`"), type_of(df.schema[c].dataType)
        none = F.lit(None)
        number, text = kind in (WHOLE, REAL), kind == TEXT
        bounded = number or kind in (DAY, INSTANT)
        aggs.append(
            F.struct(
                F.lit(c).alias("variable"), F.lit(kind).alias("type"), F.count(F.lit(1)).alias("rows"),
                (F.count(F.lit(1)) - F.count(own)).alias("nulls"),
                F.coalesce(F.round((F.count(F.lit(1)) - F.count(own)) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 2), F.lit(0.0)).alias("null_pct"),
                count(own).alias("n_distinct"),
                (F.min(own) if bounded else none).cast("string").alias("low"),
                (F.max(own) if bounded else none).cast("string").alias("high"),
                (F.round(F.avg(own.cast("double")), 4) if number else none.cast("double")).alias("mean"),
                (F.min(F.length(own)) if text else none).cast("int").alias("min_length"),
                (F.max(F.length(own)) if text else none).cast("int").alias("max_length"),
            ).alias(f"s{i}")
        )
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("s")).select("s.*")


def category_counts(df: DataFrame, columns: list[str], least: int = 5) -> DataFrame:
    """``variable, label, rows``: labels that at least ``least`` rows share; the others
    pooled per variable in a row with a null label and ``labels`` of them."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("string").alias("label")) for c in columns])
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").where("label is not null").groupBy("variable", "label").count()
    kept = F.when(F.col("count") >= least, F.col("label"))
    return counts.groupBy("variable", kept.alias("label")).agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("labels"))


def profile(df: DataFrame, max_categories: int = 0, least: int = 5, exact: bool = True) -> dict[str, Any]:
    """The profile of a table as plain data, for files and matching."""
    stats = [r.asDict() for r in column_stats(df, exact=exact).collect()]  # one row per column
    total = stats[0]["rows"] if stats else 0
    wide = [s["variable"] for s in stats if s["type"] == TEXT and 0 < s["n_distinct"] <= max_categories]
    shown: dict[str, dict] = {}
    if wide:
        rows = category_counts(df, wide, least).orderBy("variable", F.desc("rows"), "label").collect()  # few by construction
        for r in rows:
            own = shown.setdefault(r["variable"], {"categories": {}, "suppressed_categories": {"labels": 0, "rows": 0}})
            if r["label"] is None:
                own["suppressed_categories"] = {"labels": r["labels"], "rows": r["rows"]}
            else:
                own["categories"][r["label"]] = r["rows"]
    variables = []
    for s in stats:
        own = {"null_count": s["nulls"], "null_pct": s["null_pct"], "distinct_count": s["n_distinct"]}
        for a, b in (("low", "min"), ("high", "max"), ("mean", "mean"), ("min_length", "min_length"), ("max_length", "max_length")):
            if s[a] is not None:
                own[b] = s[a]
        own["unique_per_row"] = total > 0 and s["n_distinct"] == total
        variables.append({"name": s["variable"], "type": s["type"], "stats": own | shown.get(s["variable"], {})})
    return {"rows": total, "variables": variables}


def grouped_counts_k(df: DataFrame, by: list[str], k: int = 5) -> DataFrame:
    """Row counts per group, groups of fewer than ``k`` rows left out (k-anonymity)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
