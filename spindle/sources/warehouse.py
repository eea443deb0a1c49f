"""Stored tables as versioned Parquet folders, and the load of a source.

A table lives in ``<root>/tables/<name>``.  Each commit is a new file in its ``_commits``,
numbered upwards, that names the folder in use and its schema; the largest number counts, so
a reader sees the old table until the new one is complete, and no file is ever changed.
Facts are partitioned by source: reloading a source rewrites its partition alone.  Staged
text and the key map, which hold natural keys, live apart in ``<private>``.  All paths are
reached through Hadoop's file system, so both may be in any store of the cluster.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import partial, reduce
from pathlib import Path, PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.operators import checks
from spindle.operators.keys import empty_keymap, new_keys, placed_rows, with_surrogate, without_gaps
from spindle.operators.merge import fold_facts, merge_dimension
from spindle.operators.resolve import fact_rows, resolve, typed
from spindle.operators.together import together
from spindle.plans.spec import SOURCE_ID, SOURCE_ROW, Schema, Table, source_id_of, spark_field
from spindle.sources.staging import read_text
from spindle.sources.storage import Store

SOURCES = (
    "source_id string, source_name string, file_name string, file_sha256 string, schema_id string, schema_sha256 string, "
    "is_synthetic boolean, row_count long, column_count long, loaded_at timestamp_ntz"
)
#: Staged text, key maps and working tables hold mostly distinct values: no dictionaries are tried.
PLAIN = {"parquet.enable.dictionary": "false"}


def _plain(columns: Sequence[str]) -> dict[str, str]:
    """No dictionaries for these columns, whose values are mostly distinct."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


class LoadRefused(RuntimeError):
    """A load stopped by failed checks; ``summary`` has them."""

    def __init__(self, summary: dict[str, Any]):
        failed = [f"{r['check']} {r['target']}" for r in summary["results"] if r["severity"] == "error" and not r["passed"]]
        super().__init__(f"checks failed: {', '.join(failed)}")
        self.summary = summary


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | Path, private: str | Path | None = None):
        self.spark, self.root, self.store = spark, str(root).rstrip("/"), Store(spark)
        self.private = str(private).rstrip("/") if private else f"{self.root}_private"

    # --- tables

    def _dir(self, name: str, private: bool = False) -> str:
        return f"{self.private if private else self.root + '/tables'}/{name}"

    def _commits(self, name: str, private: bool = False) -> list[str]:
        return [c for c in self.store.children(f"{self._dir(name, private)}/_commits") if c.endswith(".json")]

    def _state(self, name: str, private: bool = False) -> tuple[str, T.StructType]:
        """Folder and schema of the last commit."""
        last = json.loads(self.store.read(f"{self._dir(name, private)}/_commits/{self._commits(name, private)[-1]}"))
        return f"{self._dir(name, private)}/{last['folder']}", T.StructType.fromJson(last["schema"])

    def _commit(self, name: str, folder: str, schema: T.StructType, private: bool = False) -> None:
        number = len(self._commits(name, private)) + 1
        text = json.dumps({"folder": PurePosixPath(folder).name, "schema": schema.jsonValue()})
        self.store.create(f"{self._dir(name, private)}/_commits/{number:09d}.json", text)

    def exists(self, name: str, private: bool = False) -> bool:
        return bool(self._commits(name, private))

    def names(self) -> list[str]:
        return [n for n in self.store.children(f"{self.root}/tables") if self.exists(n)]

    def read(self, name: str, private: bool = False) -> DataFrame:
        folder, schema = self._state(name, private)
        return self.spark.read.schema(schema).parquet(folder).select(*schema.names)

    def write(self, name: str, df: DataFrame, private: bool = False, by_source: bool = False, distinct: Sequence[str] = ()) -> None:
        """A new version of a table, committed when it is complete; ``distinct`` as in ``_plain``."""
        folder = f"{self._dir(name, private)}/v{len(self._commits(name, private)) + 1}"
        writer = df.write.mode("overwrite").options(**PLAIN if private else _plain(distinct))
        (writer.partitionBy(SOURCE_ID) if by_source else writer).parquet(folder)
        self._commit(name, folder, df.schema, private)

    def write_source(self, name: str, df: DataFrame, distinct: Sequence[str] = ()) -> None:
        """Replaces one source's partition of a fact; other sources are not touched."""
        if not self.exists(name):
            return self.write(name, df, by_source=True, distinct=distinct)
        folder, stored = self._state(name)
        fields = {f.name: f for f in stored} | {f.name: f for f in df.schema if f.name not in stored.names}
        for f in df.schema:
            if f.name in stored.names and stored[f.name].dataType != f.dataType:
                raise TypeError(f"{name}.{f.name} is {stored[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**_plain(distinct))
        writer.partitionBy(SOURCE_ID).parquet(folder)
        return self._commit(name, folder, T.StructType(list(fields.values())))

    def table_counts(self) -> DataFrame:
        """``table_name, rows`` of all tables."""
        out = self.spark.createDataFrame([], "table_name string, rows long")
        for name in self.names():
            out = out.unionByName(self.read(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
        return out

    def first_rows(self, name: str, n: int = 100, order: list[str] | None = None) -> DataFrame:
        """The first ``n`` rows of a table in the order of the given columns, else of all."""
        df = self.read(name)
        return df.orderBy(*(order or df.columns)).limit(n)

    def query(self, sql: str) -> DataFrame:
        """SQL over the stored tables, under their names."""
        for name in self.names():
            self.read(name).createOrReplaceTempView(name)
        return self.spark.sql(sql)

    # --- loads

    def keymap(self) -> DataFrame:
        return self.read("key_map", private=True) if self.exists("key_map", True) else empty_keymap(self.spark)

    def staged(self, source: str) -> DataFrame:
        """The raw rows of a source with their numbers; written once, numbered as they are read."""
        return without_gaps(self.read(f"stg_{source}", private=True), SOURCE_ROW)

    def _stored_type_check(self, schema: Schema) -> None:
        """Refuses a schema whose column types differ from the stored ones."""
        for t in schema.tables.values():
            if not self.exists(t.name):
                continue
            stored = {f.name: f.dataType for f in self.read(t.name).schema}
            keys = {d.key for d in schema.dimensions}
            for n, c in schema.physical(t).items():
                want = spark_field(c, n in keys).dataType
                if n in stored and stored[n] != want:
                    raise TypeError(f"{t.name}.{n} is {stored[n].simpleString()}, not {want.simpleString()}")

    def load(
        self, schema: Schema, path: str, source_name: str | None = None, synthetic: bool = False, force: bool = False,
        compat: bool = False, multi_line: bool = True,
    ) -> dict[str, Any]:
        """Stages, checks, keys, writes and checks again; returns the summary (counts only).

        Failed error checks before the load refuse it unless ``force``.  ``multi_line``: whether
        cells may hold line ends (then one task reads each file)."""
        source = source_id_of(source_name or PurePosixPath(path).stem)
        self.write(f"stg_{source}", placed_rows(read_text(self.spark, path, multi_line)), private=True)
        with self._workspace() as put:
            return self._load(schema, self.staged(source), put, source, source_name or PurePosixPath(path).stem, path, synthetic, force, compat)

    @contextmanager
    def _workspace(self) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
        """Writes tables of one run to a private folder and reads them back; it goes at the end.

        Many casts in one stage make one generated method; beyond 8,000 bytes Java only interprets
        it, so meanwhile such stages run operator by operator, in methods that Spark splits."""
        folder, limit = f"{self.private}/_work/{uuid.uuid4().hex}", "spark.sql.codegen.hugeMethodLimit"
        former = self.spark.conf.get(limit)
        self.spark.conf.set(limit, "8000")

        def put(df: DataFrame, name: str) -> DataFrame:
            df.write.options(**PLAIN).parquet(f"{folder}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        try:
            yield put
        finally:
            self.spark.conf.set(limit, former)
            self.store.remove(folder)

    def _load(self, schema, staged, put, source, source_name, path, synthetic, force, compat) -> dict[str, Any]:
        self._stored_type_check(schema)
        res = resolve(schema, staged.columns, compat)
        once = checks.Parsed.of(staged, res, put)
        results = checks.preflight(staged, res, self.keymap(), source, once)
        summary = checks.summarize(results)
        if not summary["ok"] and not force:
            raise LoadRefused(summary)
        self._assign_keys(once, source)
        keyed = {t.name: self._keyed(once, t) for t in schema.tables.values()}
        named = list(once.firsts)  # read twice: stored and compared
        keyed |= zip(named, together([partial(put, keyed[name], f"keyed_{name}") for name in named]))
        for t in [d for d in schema.dimensions if d.name != schema.spine_table] + [schema.tables[schema.spine_table]]:
            if res.has(t.columns[t.key]):
                self._write_dimension(schema, t, keyed[t.name], source)
        for t in schema.facts:
            if res.content(t):
                self._write_fact(schema, t, keyed[t.name], source)
        self._register(schema, source, source_name, path, synthetic, once)
        results += self._postload(schema, once, keyed, source)
        return checks.summarize(results) | {"source_id": source, "schema_id": schema.schema_id}

    def _assign_keys(self, once: checks.Parsed, source: str) -> None:
        keymap = self.keymap()

        def fresh_of(name: str, rows: DataFrame) -> DataFrame | None:
            naturals = rows.select(F.col(once.res.schema.key_of(name)).cast("string").alias("natural_key"), F.col(SOURCE_ROW).alias("first_row"))
            made = new_keys(naturals, keymap, name, source)
            return None if made.isEmpty() else made

        fresh = [f for f in together([partial(fresh_of, *item) for item in once.firsts.items()]) if f is not None]
        if fresh or not self.exists("key_map", True):
            self.write("key_map", reduce(DataFrame.unionByName, fresh, keymap), private=True)

    def _keyed(self, once: checks.Parsed, t: Table) -> DataFrame:
        """Typed rows of a table with generated keys in place of natural ones; of a dimension its
        first values, one row for each key.  A fact's rows are joined with the spine's keys last and keep the natural
        one as ``_spine``, by which they are then dealt out."""
        schema, keymap = once.res.schema, self.keymap()
        rows = fact_rows(once.rows, once.res, t) if t.is_fact else once.firsts.get(t.name)
        if rows is None:  # a dimension without its key
            return typed(once.rows, once.res, t).limit(0)
        own = schema.spine_table if t.is_fact else t.name
        for d in [*(d for d in schema.links(t) if d != own), own]:
            rows = with_surrogate(rows, keymap, d, schema.key_of(d), "_spine" if t.is_fact and d == own else None)
        return rows if t.is_fact else rows.where(F.col(t.key).isNotNull())

    def _write_dimension(self, schema: Schema, t: Table, rows: DataFrame, source: str) -> None:
        new = rows.withColumn(SOURCE_ID, F.lit(source)).select(*schema.physical(t), SOURCE_ID)
        self.write(t.name, merge_dimension(self.read(t.name), new, t.key) if self.exists(t.name) else new)

    def _write_fact(self, schema: Schema, t: Table, rows: DataFrame, source: str) -> None:
        own = fold_facts(rows).drop("_spine").withColumn(SOURCE_ID, F.lit(source)).select(*schema.physical(t), SOURCE_ID, SOURCE_ROW)
        self.write_source(t.name, own, (schema.spine_key, SOURCE_ROW))

    def _register(self, schema, source, source_name, path, synthetic, once: checks.Parsed) -> None:
        row = (
            source, source_name, PurePosixPath(path).name, self.store.sha256(path) if self.store.is_file(path) else None, schema.schema_id,
            hashlib.sha256(schema.to_yaml().encode()).hexdigest(), synthetic, once.rows.count(), len(once.res.columns),
            datetime.datetime.now().replace(microsecond=0),
        )
        own = self.spark.createDataFrame([row], SOURCES)
        if self.exists("dim_data_source"):
            own = self.read("dim_data_source").where(F.col("source_id") != source).unionByName(own)
        self.write("dim_data_source", own)

    def _postload(self, schema: Schema, once: checks.Parsed, keyed: dict[str, DataFrame], source: str) -> list[checks.Result]:
        """The source with its keys mapped, against the stored tables."""
        tables = {t.name: self.read(t.name) for t in schema.tables.values() if self.exists(t.name)}
        registered = self.read("dim_data_source").where(F.col("source_id") == source).count()
        return checks.postload(keyed, once.res, tables, source, registered)

    def check(self, schema: Schema, source_name: str, compat: bool = False) -> dict[str, Any]:
        """All checks again for a loaded source."""
        source = source_id_of(source_name)
        staged = self.staged(source)
        res = resolve(schema, staged.columns, compat)
        with self._workspace() as put:
            once = checks.Parsed.of(staged, res, put)
            keyed = {t.name: self._keyed(once, t) for t in schema.tables.values()}
            results = checks.preflight(staged, res, self.keymap(), source, once) + self._postload(schema, once, keyed, source)
        return checks.summarize(results) | {"source_id": source, "schema_id": schema.schema_id}

    def record_issues(self, schema: Schema, source: str, summary: dict[str, Any]) -> str:
        """The data issues of a load as a new JSON file, ``<root>/data_issues/<source>/<n>.json``."""
        issues = [r for r in summary["results"] if r["severity"] == "data_issue" and not r["passed"]]
        folder = f"{self.root}/data_issues/{source}"
        out = f"{folder}/{len(self.store.children(folder)) + 1:06d}.json"
        self.store.create(out, json.dumps({"schema_id": schema.schema_id, "source_id": source, "issues": issues}, indent=2, default=str))
        return out
