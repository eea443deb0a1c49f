"""Dummy data in the shape of a schema's raw export, generated on the executors."""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.types import DAY, INSTANT, REAL, TRUTH, WHOLE, plain_name
from spindle.plans.spec import Column, Schema, Table

MOST_ROWS, NULL_SHARE, POOL = 400, 0.03, 20
DATES = ("2024-01-01", "2025-12-31")


def _roll(seed: int, *parts: Expr) -> Expr:
    """A number in [0, 1) that depends only on its parts: the same on any cluster."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _pick(options: list[Any], weights: list[float] | None, roll: Expr) -> Expr:
    weights = weights if weights and sum(weights) > 0 else [1.0] * len(options)
    total, upto, out = sum(weights), 0.0, F.lit(str(options[-1]))
    bounds = []
    for w in weights:
        upto += w / total
        bounds.append(upto)
    for option, bound in reversed(list(zip(options[:-1], bounds))):
        out = F.when(roll < bound, F.lit(str(option))).otherwise(out)
    return out


def _number(v: Any, default: float) -> float:
    try:
        return float(v)
    except (TypeError, ValueError):
        return default


def value(c: Column, stats: dict[str, Any], seed: int, *of: Expr) -> Expr:
    """A text value of a column: its allowed values, profile, range or type decide."""
    name = F.lit(f"{c.table}.{c.name}")
    roll = _roll(seed, name, *of)
    seen = stats.get("categories") or {}
    low, high = c.range or (stats.get("min"), stats.get("max"))
    if c.allowed:
        out = _pick(list(c.allowed), [float(seen.get(str(a), 0)) for a in c.allowed], roll)
    elif seen and c.type == "VARCHAR" and not c.pii:
        out = _pick(list(seen), [float(n) for n in seen.values()], roll)
    elif c.type == TRUTH:
        out = F.when(roll < 0.5, F.lit("true")).otherwise("false")
    elif c.type in (REAL, WHOLE):
        a, b = _number(low, 0.0), _number(high, 100.0)
        a, b = (a, b) if a <= b else (0.0, 100.0)
        out = F.format_string("%.2f", a + roll * (b - a)) if c.type == REAL else F.floor(a + roll * (b - a + 1)).cast("bigint").cast("string")
    elif c.type in (DAY, INSTANT):
        first, last = (datetime.date.fromisoformat(str(v)[:10]) for v in (low or DATES[0], high or DATES[1]))
        day = F.date_add(F.lit(first), F.floor(roll * ((last - first).days + 1)).cast("int")).cast("string")
        clock = F.format_string("%02d:%02d:00", F.floor(roll * 24).cast("int"), F.floor(roll * 1440 % 60).cast("int"))
        out = day if c.type == DAY else F.concat_ws(" ", day, clock)
    else:
        out = F.concat(F.lit(f"{c.name}_"), (F.floor(roll * 6) + 1).cast("string"))
    if c.required or c.role == "key":
        return out
    share = float(stats["null_pct"]) / 100 if stats.get("null_pct") is not None else NULL_SHARE
    return F.when(_roll(seed + 1, name, *of) >= share, out)


def _key(c: Column, n: Expr) -> Expr:
    return F.format_string(f"{c.name.upper()}-%05d", n)


def generate(
    spark: SparkSession, schema: Schema, visits: int = 200, seed: int = 7, eda: dict[str, Any] | None = None, most_rows: int | None = MOST_ROWS
) -> DataFrame:
    """A wide text table as a raw export would be: per visit one to three rows of the main
    fact, its dimensions drawn from pools, whole visits only up to ``most_rows``.

    Equal seeds give equal rows on any number of partitions."""
    stats = {plain_name(v["name"]): v.get("stats", {}) for v in (eda or {}).get("variables", [])}
    of = lambda c: next((stats[n] for n in [*c.reads, plain_name(c.name)] if n in stats), {})
    main = schema.tables[schema.main_fact]
    per = lambda n: F.floor(_roll(seed, F.lit("rows"), n) * (3 if main.grain and len(main.grain) > 1 else 1)).cast("int") + 1
    base = spark.range(1, visits + 1).select(F.col("id").alias("_v"))
    if most_rows:
        from pyspark.sql import Window

        # The table of visit sizes is as small as the row limit, so one window will do.
        small = base.where(F.col("_v") <= most_rows).withColumn("_n", per(F.col("_v")))
        upto = F.sum("_n").over(Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
        base = small.withColumn("_upto", upto).where(F.col("_upto") <= most_rows).select("_v", "_n")
    else:
        base = base.withColumn("_n", per(F.col("_v")))
    df = base.select("_v", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_r"))
    columns: dict[str, Expr] = {}
    numbers: dict[str, Expr] = {schema.spine_table: F.col("_v")}

    def number(t: Table) -> Expr:
        if t.name not in numbers:
            holder = next((d for d in schema.dimensions if t.name in schema.links(d)), None)
            at = number(holder) if holder is not None else F.struct("_v", "_r")
            size = int(t.synthetic.get("rows", POOL))
            numbers[t.name] = F.floor(_roll(seed, F.lit(t.name), at) * size).cast("bigint") + 1
        return numbers[t.name]

    def put(c: Column, expr: Expr) -> None:
        if c.expr:
            for i in c.inputs:
                example = F.lit(c.input_examples[0]) if c.input_examples else F.date_add(F.lit(DATES[0]).cast("date"), F.pmod(F.xxhash64("_v", F.lit(i)), F.lit(700)).cast("int")).cast("string")
                columns.setdefault(i, example)
        elif not c.crosswalk and not c.from_key:
            columns.setdefault(c.source or c.name, expr)

    for t in schema.dimensions:
        n = number(t)
        for c in t.columns.values():
            put(c, _key(c, n) if c.name == t.key else value(c, of(c), seed, n))
    for t in schema.facts:
        at = (F.col("_v"), F.col("_r")) if t.name == main.name else (F.col("_v"),)
        for c in t.columns.values():
            put(c, value(c, of(c), seed, *at))
    return df.orderBy("_v", "_r").select(*[e.alias(n) for n, e in columns.items()])


def catalogue(schema: Schema) -> list[dict[str, Any]]:
    """The data dictionary of the generated export."""
    return [
        {"variable": c.source or c.name, "description": c.description, "type": c.type, "allowed_values": "|".join(map(str, c.allowed or []))}
        for c in schema.all_columns() if not (c.expr or c.crosswalk or c.from_key)
    ]


def write_dataset(spark: SparkSession, schema: Schema, folder: str, visits: int = 200, seed: int = 7, eda: dict | None = None) -> dict[str, str]:
    """Export, catalogue and profile of a dummy dataset under ``folder``."""
    from pathlib import Path

    from spindle.operators.profile import profile
    from spindle.sources.dictionary import write_eda

    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    df = generate(spark, schema, visits, seed, eda)
    paths = {k: str(out / f"{schema.schema_id}_{k}") for k in ("data.csv", "catalogue.csv", "eda.yaml")}
    df.toPandas().to_csv(paths["data.csv"], index=False)  # at most MOST_ROWS rows
    import pandas as pd

    pd.DataFrame(catalogue(schema)).to_csv(paths["catalogue.csv"], index=False)
    write_eda(profile(df, max_categories=20), paths["eda.yaml"])
    return paths
