"""Whole runs: the field inventory, and the pipeline over a warehouse."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from spindle.operators import latency
from spindle.operators.graph import JoinGraph
from spindle.operators.resolve import Resolution
from spindle.operators.slicer import deep_slices
from spindle.plans.spec import Schema
from spindle.sources.warehouse import Warehouse


@dataclass
class FieldEntry:
    variable: str
    data_type: str
    role: str
    table: str
    is_key: bool


class FieldInventory:
    """Where every raw variable of a source goes."""

    def __init__(self, res: Resolution):
        self.raw = list(res.columns)
        self.entries: dict[str, FieldEntry] = {v: FieldEntry(v, "", "excluded", "-", False) for v in res.excluded}
        for c in res.schema.all_columns():
            for v in res.feeds.get((c.table, c.name), []):
                self.entries.setdefault(v, FieldEntry(v, c.type, c.role, c.table, c.role == "key"))

    def left_out(self) -> list[str]:
        return [v for v in self.raw if v not in self.entries]

    def switch(self, variable: str, table: str, role: str | None = None) -> FieldEntry:
        if variable not in self.entries:
            raise KeyError(variable)
        own = self.entries[variable]
        own.table, own.role = table, role or own.role
        return own

    def rows(self) -> list[dict[str, Any]]:
        return [vars(e) for e in self.entries.values()]


def star(tables: dict[str, DataFrame], schema: Schema) -> DataFrame:
    """The spine with its linked dimensions, all spine rows kept."""
    graph = JoinGraph.of(schema)
    ends = [d for d in schema.links(schema.tables[schema.spine_table]) if d in tables]
    drop = lambda df: df.drop("_source_id", "_source_row")
    own = {n: drop(df) for n, df in tables.items()}
    return graph.joined(own, schema.spine_table, *ends, how="left")


def run_pipeline(house: Warehouse, schema: Schema, sources: list[str], slice_dims: int = 6, depth: tuple[int, int] = (2, 4)) -> dict[str, Any]:
    """Checks of every source, join paths of the main fact, deep slices over the coded
    attributes around the spine, and the time of a count."""
    tables = {t: house.read(t) for t in schema.tables if house.exists(t)}
    around = [schema.spine_table, *schema.links(schema.tables[schema.spine_table])]
    coded = [c.name for t in around for c in schema.tables[t].columns.values() if c.allowed and not c.pii][:slice_dims]
    slices = []
    if len(coded) >= depth[0]:
        found = deep_slices(star(tables, schema), coded, depth[0], min(depth[1], len(coded)))
        slices = [r.asDict() for r in found.collect()]  # one row per combination of at most slice_dims
    graph = JoinGraph.of(schema)
    return {
        "schema_id": schema.schema_id,
        "checks": {s: house.check(schema, s) for s in sources},
        "paths": graph.paths_from(schema.main_fact),
        "slices": slices,
        "latency": latency.timed(lambda: tables[schema.main_fact].groupBy().count(), "rows of the main fact").to_dict(),
    }
