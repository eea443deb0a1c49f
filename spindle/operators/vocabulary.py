"""Labels of a vocabulary variable, and the crosswalk files that map them."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.types import plain_label, plain_name, trimmed

MOST_LABELS, FREE_FROM, FREE_SHARE = 500, 30, 0.5


class VocabularyError(ValueError):
    """A variable whose values must not, or cannot usefully, be listed."""


def labels(files: Iterable[DataFrame], variable: str, by: str | None = None) -> DataFrame:
    """``label, scope`` rows of a variable over all files that have it."""
    out = None
    for df in files:
        names = {plain_name(c): c for c in df.columns}
        column = names.get(plain_name(variable))
        if column is None:
            continue
        scope = names.get(plain_name(by)) if by else None
        own = df.select(
            trimmed(F.col(f"`{column}`")).alias("label"),
            (trimmed(F.col(f"`{scope}`")) if scope else F.lit(None).cast("string")).alias("scope"),
        )
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise VocabularyError(f"no file has {variable!r}")
    return out


def label_counts(
    files: Iterable[DataFrame], variable: str, by: str | None = None, identifiers: Iterable[str] = (), most: int = MOST_LABELS
) -> DataFrame:
    """``label, rows, seen_at`` of a vocabulary, the most frequent first.

    Refused for identifiers, for what looks like free text (more than ``FREE_FROM``
    values that are more than half of the rows), and for more than ``most`` labels."""
    if plain_name(variable) in {plain_name(i) for i in identifiers}:
        raise VocabularyError(f"{variable} is an identifier; its values are not listed")
    rows = labels(files, variable, by)
    seen = rows.agg(F.count("label").alias("n"), F.count_distinct("label").alias("d")).first()
    if seen["d"] > FREE_FROM and seen["d"] > FREE_SHARE * max(1, seen["n"]):
        raise VocabularyError(f"{variable} looks like free text: {seen['d']} values in {seen['n']} rows")
    if seen["d"] > most:
        raise VocabularyError(f"{variable} has {seen['d']} values, more than {most}")
    out = rows.where("label is not null").groupBy("label")
    out = out.agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set("scope")).alias("seen_at"))
    return out.orderBy(F.desc("rows"), "label")


def merge_crosswalk(path: str | Path, name: str, variable: str, found: Iterable[str]) -> dict:
    """Adds labels that the crosswalk file lacks, unmapped; mappings that it has stay."""
    path = Path(path)
    data = yaml.safe_load(path.read_text(encoding="utf-8")) if path.exists() else None
    data = data or {"name": name, "from": variable, "entries": []}
    known = {plain_label(e["value"]) for e in data["entries"]}
    added = []
    for label in found:
        if plain_label(label) not in known:
            known.add(plain_label(label))
            data["entries"].append({"value": label, "maps_to": ""})
            added.append(label)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(yaml.safe_dump(data, sort_keys=False, allow_unicode=True), encoding="utf-8")
    waiting = sum(1 for e in data["entries"] if not e.get("maps_to"))
    return {"path": str(path), "entries": len(data["entries"]), "added": added, "unmapped": waiting}
