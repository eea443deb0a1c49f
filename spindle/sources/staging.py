"""Raw exports as text tables with a row number, and typed for profiling."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.operators.keys import numbered, numbered_as_read
from spindle.plans.spec import SOURCE_ROW
from spindle.sources import office

OPTIONS = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}


def read_text(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV file with every column as text.  A file whose cells hold line ends is read by one
    task; without them (``multi_line=False``) it is split among tasks."""
    return spark.read.options(**OPTIONS | {"multiLine": multi_line}, inferSchema=False).csv(path)


def stage_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Text columns and the row number of a CSV file."""
    return numbered_as_read(read_text(spark, path, multi_line), SOURCE_ROW)


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with types inferred from all rows (for profiles, not for loads)."""
    return spark.read.options(**OPTIONS, inferSchema=True, samplingRatio=1.0).csv(path)


def _texts(df: DataFrame) -> list:
    return [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]


def stage_frame(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Any table as a raw export: all columns as text, numbered in ``order`` (total) if
    given, else as they come."""
    if order is None:
        return numbered_as_read(df.select(*_texts(df)), SOURCE_ROW)
    return numbered(df, order, SOURCE_ROW).select(*_texts(df), SOURCE_ROW)


#: Kinds of data files (fixed values).
TABLES = (".csv", ".tsv", ".parquet", ".json")


def data_entries(folder: str | Path) -> list[str]:
    """Data files of a folder by name, hidden ones left out.  Of a workbook with several
    sheets each is an entry, ``book.xlsx#Sheet``."""
    out: list[str] = []
    for file in sorted(Path(folder).glob("*")):
        kind = file.suffix.lower()
        if file.name.startswith((".", "~")):
            continue
        if kind in (".xlsx", ".xlsm"):
            sheets = list(office.sheet_parts(file))
            out += [f"{file}#{s}" for s in sheets] if len(sheets) > 1 else [str(file)]
        elif kind in TABLES:
            out.append(str(file))
    return out


def split_entry(entry: str) -> tuple[str, str | None]:
    """File and sheet of an entry name."""
    path, mark, sheet = entry.partition("#")
    return path, sheet if mark else None


def entry_stem(entry: str) -> str:
    """The name of an entry's source: ``visits``, or ``book__Sheet_2`` for a sheet."""
    path, sheet = split_entry(entry)
    return "__".join([Path(path).stem, *(["_".join(re.findall(r"[A-Za-z0-9]+", sheet))] if sheet else [])])


def read_entry(spark: SparkSession, entry: str) -> DataFrame:
    """An entry as text columns, by the kind of its file."""
    path, sheet = split_entry(entry)
    kind = Path(path).suffix.lower()
    if kind in (".xlsx", ".xlsm"):
        rows = office.records(list(office.sheet_rows(path, sheet)))
        names = list(rows[0]) if rows else ["_empty"]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        return spark.createDataFrame([tuple(r[n] or None for n in names) for r in rows], schema)
    if kind == ".parquet":
        df = spark.read.parquet(path)
        return df.select(*_texts(df))
    if kind == ".json":
        df = spark.read.json(path)
        return df.select(*_texts(df))
    return spark.read.options(**OPTIONS, sep="\t" if kind == ".tsv" else ",").csv(path)
