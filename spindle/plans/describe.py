"""The description of a dataset: what the user said about it, and what its files show."""

from __future__ import annotations

import copy
import csv
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spindle.operators import pages
from spindle.operators.profile import profile
from spindle.sources.dictionary import write_eda
from spindle.sources.office import document_text
from spindle.sources.staging import data_entries, entry_stem, read_entry

#: Fields of a description (fixed values).
BLANK: dict[str, Any] = {
    "dataset": {"name": "", "period_covered": "", "files": []},
    "study": {"description": "", "main_question": "", "secondary_questions": [], "study_type": ""},
    "unit_of_analysis": {"one_row_is": "", "main_event": ""},
    "privacy": {"direct_identifiers": [], "quasi_identifiers": []},
    "codes_and_vocabularies": [],
    "documents": [],
    "placement": "",
}
REQUIRED = ("study.description", "study.main_question", "unit_of_analysis.one_row_is", "unit_of_analysis.main_event")


def empty_fields(data: dict[str, Any], names: tuple[str, ...] = REQUIRED) -> list[str]:
    """Which of the named fields have no answer yet."""
    out = []
    for name in names:
        at: Any = data
        for part in name.split("."):
            at = (at or {}).get(part)
        if at in (None, "", [], {}):
            out.append(name)
    return out


def inside(folder: Path, name: str) -> Path:
    """A path within the inputs folder; others are refused."""
    path = (Path(folder) / name).resolve()
    if not path.is_relative_to(Path(folder).resolve()):
        raise ValueError(f"{name} lies outside the inputs folder")
    if not path.exists():
        raise ValueError(f"{name} does not exist")
    return path


def _entries(path: Path) -> int:
    with path.open(newline="", encoding="utf-8-sig") as f:
        return max(0, sum(1 for _ in csv.reader(f)) - 1)


def describe(spark: SparkSession, inputs: str | Path, name: str, answers: dict[str, Any] | None = None, codes: tuple[str, ...] = (), documents: tuple[str, ...] = ()) -> dict[str, Any]:
    """Writes ``<inputs>/<name>_concept.yaml``: the answers so far, the data files with
    profiles (made where missing), code lists with their sizes, and documents with the
    pages that answer each question."""
    folder = Path(inputs)
    out = copy.deepcopy(BLANK)
    for field, value in (answers or {}).items():
        group, _, key = field.partition(".")
        if group not in out or (key and key not in out[group]):
            raise ValueError(f"no field {field!r}")
        if key:
            out[group][key] = value
        else:
            out[group] = value
    out["dataset"]["name"] = name
    skip = {inside(folder, c) for c in codes}
    for entry in data_entries(folder):
        if Path(entry).resolve() in skip:
            continue
        eda = folder / f"{entry_stem(entry)}_eda.yaml"
        if not eda.exists():
            write_eda(profile(read_entry(spark, entry), max_categories=50), eda)
        out["dataset"]["files"].append({"file": Path(entry).name, "eda": eda.name})
    out["codes_and_vocabularies"] = [{"file": c, "entries": _entries(inside(folder, c))} for c in codes]
    for d in documents:
        path = inside(folder, d)
        text = document_text(path) if path.suffix.lower() == ".docx" else path.read_text(encoding="utf-8", errors="replace")
        df = spark.createDataFrame([(d, text)], "file string, text string")
        size = pages.document_summary(df, "file", "text").first()
        own: dict[str, Any] = {"file": d, "pages": size["pages"], "words": size["words"]}
        if size["long"]:
            found = pages.concept_pages(df, "file", "text").groupBy("concept").agg(F.array_sort(F.collect_set("page")).alias("pages"))
            own["concept_pages"] = {r["concept"]: list(r["pages"]) for r in found.collect()}  # a page list per concept
        out["documents"].append(own)
    (folder / f"{name}_concept.yaml").write_text(yaml.safe_dump(out, sort_keys=False, allow_unicode=True), encoding="utf-8")
    return out
