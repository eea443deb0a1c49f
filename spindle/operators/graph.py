"""The join graph of tables: shortest paths, and DataFrames joined along them."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame

from spindle.plans.spec import Schema


class JoinGraph:
    """Undirected: an edge joins two tables on a pair of columns."""

    def __init__(self):
        self.edges: dict[str, dict[str, tuple[str, str]]] = {}

    def add(self, a: str, b: str, key_a: str, key_b: str | None = None) -> JoinGraph:
        if not key_a:
            raise ValueError(f"no key between {a} and {b}")
        key_b = key_b or key_a
        self.edges.setdefault(a, {})[b] = (key_a, key_b)
        self.edges.setdefault(b, {})[a] = (key_b, key_a)
        return self

    @classmethod
    def of(cls, schema: Schema) -> JoinGraph:
        graph = cls()
        for table, dimension, key in schema.relationships():
            graph.add(table, dimension, key)
        return graph

    def path(self, start: str, end: str) -> list[str]:
        """Tables on a shortest path, both ends included; empty if there is none."""
        came: dict[str, str | None] = {start: None}
        queue = deque([start])
        while queue and end not in came:
            here = queue.popleft()
            for there in self.edges.get(here, {}):
                if there not in came:
                    came[there] = here
                    queue.append(there)
        if end not in came or (start not in self.edges and start != end):
            return []
        out, at = [], end
        while at is not None:
            out.append(at)
            at = came[at]
        return out[::-1]

    def joins(self, start: str, end: str) -> int:
        """Number of joins on the way, -1 without one."""
        path = self.path(start, end)
        return len(path) - 1 if path else -1

    def sql(self, start: str, end: str) -> str:
        """FROM clause along the shortest path."""
        path = self.path(start, end)
        if not path:
            raise ValueError(f"no path from {start} to {end}")
        parts = [start]
        for a, b in zip(path, path[1:]):
            key_a, key_b = self.edges[a][b]
            parts.append(f"JOIN {b} ON {a}.{key_a} = {b}.{key_b}")
        return " ".join(parts)

    def joined(self, tables: dict[str, DataFrame], start: str, *ends: str, how: str = "inner") -> DataFrame:
        """The start table joined along the shortest paths to all ``ends``.  The optimiser
        picks the join strategies; a key column that both sides name alike occurs once."""
        df, seen = tables[start], {start}
        for end in ends:
            path = self.path(start, end)
            if not path:
                raise ValueError(f"no path from {start} to {end}")
            for a, b in zip(path, path[1:]):
                if b in seen:
                    continue
                seen.add(b)
                key_a, key_b = self.edges[a][b]
                if key_a == key_b:
                    df = df.join(tables[b], key_a, how)
                else:
                    df = df.join(tables[b], df[key_a] == tables[b][key_b], how)
        return df

    def paths_from(self, fact: str) -> list[dict]:
        """Every other table with its distance and path, the nearest first."""
        found = [(t, self.path(fact, t)) for t in self.edges if t != fact]
        rows = [{"target": t, "joins": len(p) - 1 if p else -1, "path": " -> ".join(p)} for t, p in found]
        return sorted(rows, key=lambda r: (r["joins"] < 0, r["joins"], r["target"]))
