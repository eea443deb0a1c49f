"""What a load reads and compares."""

import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spindle.functions.types import BLANKS, safe_cast
from spindle.operators import checks, resolve
from spindle.sources.staging import stage_csv
from spindle.sources.warehouse import Warehouse
from tests.test_constellation import ROWS, export, failed, schema


@pytest.mark.parametrize("again", [False, True])
def test_raw_text_is_cast_once(spark, tmp_path, monkeypatch, again):
    """No comparison after the load casts the raw text again, and nothing is held in memory."""
    house, seen, plain = Warehouse(spark, tmp_path / "h"), [], checks.postload

    def watched(source, *rest):
        frames = list(source.values()) if isinstance(source, dict) else [source]
        seen.extend(f for df in frames for f in df.inputFiles())
        seen.extend(["held"] * spark.sparkContext._jsc.getPersistentRDDs().size())
        return plain(source, *rest)

    spark.catalog.clearCache()
    house.load(schema(), export(tmp_path / "a.csv"), "a")
    monkeypatch.setattr(checks, "postload", watched)
    summary = house.check(schema(), "a") if again else house.load(schema(), str(tmp_path / "a.csv"), "a")
    assert summary["ok"] and any("/_work/" in f for f in seen)
    assert not [f for f in seen if "/stg_" in f or f == "held"]
    assert house.store.children(f"{house.private}/_work") == []


def test_one_pass_counts_missing_repeated_and_changed_rows(spark, tmp_path):
    house, s = Warehouse(spark, tmp_path / "h"), schema()
    house.load(s, export(tmp_path / "a.csv"), "a")
    facts, people = house.read("fact_results").collect(), house.read("dim_person").collect()
    kept = [r for r in facts if r["amount"] != 3.0] + [r for r in facts if r["amount"] == 2.5]
    house.write("fact_results", spark.createDataFrame(kept, house.read("fact_results").schema), by_source=True)
    changed = [r if r["sex"] == "Male" else type(r)(**r.asDict() | {"sex": "Male"}) for r in people]
    house.write("dim_person", spark.createDataFrame([*changed, *(r for r in people if r["sex"] == "Male")], house.read("dim_person").schema))
    house.write("dim_visit", house.read("dim_visit").where("ward <> 'Pediatric'").localCheckpoint())
    summary = house.check(s, "a")
    found = failed(summary)
    assert found[("value_parity", "fact_results")] == 2 and ("fact_row_parity", "fact_results") not in found
    assert float(found[("measure_sum_parity", "fact_results.amount")]) == 6.5
    assert found[("value_parity", "dim_person")] == 3 and found[("derived_parity", "dim_person.birth_year")] == 1
    assert found[("entity_coverage", "dim_visit")] == 2 and ("value_parity", "dim_visit") not in found
    assert found[("orphan_keys", "fact_results.visit_id")] == 3


def test_casts_without_regular_expressions_give_the_same(spark):
    texts = [" 2024-01-02　", "2024/1/2", "2024-01", "2024-01-0", "+202-01-02", "2024-02-30", "1.5", "1.5d", "1.5D\n", "-inf", "1e3", "NaN", "f", " ", " ", "\t1", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string").coalesce(1)
    day, real, text = zip(*df.select(*[safe_cast(F.col("x"), k).cast("string") for k in ("DATE", "DOUBLE", "VARCHAR")]).collect())
    assert day == ("2024-01-02", "2024-01-02", *[None] * 15)
    assert real == (*[None] * 6, "1.5", None, None, "-Infinity", "1000.0", "NaN", *[None] * 3, "1.0", None)
    assert text == tuple(None if x is None else x.strip(BLANKS) or None for x in texts)


def test_first_values_and_keys_are_made_once(spark, tmp_path, monkeypatch):
    """A load folds a dimension's keys once, and only those that occur in several rows; a source
    without new keys leaves the key map as it is."""
    house, folded, plain = Warehouse(spark, tmp_path / "h"), [], checks.first_values
    monkeypatch.setattr(checks, "first_values", lambda df, key, *a, **k: folded.append(key) or plain(df, key, *a, **k))
    house.load(schema(), export(tmp_path / "a.csv"), "a")
    assert len(folded) == len(set(folded))
    assert house._commits("key_map", True) == ["000000001.json"]
    house.load(schema(), str(tmp_path / "a.csv"), "a")
    assert house._commits("key_map", True) == ["000000001.json"]


def test_blanks_are_stripped_once_from_each_raw_column(spark):
    staged = spark.createDataFrame([("  1 ", " 2.5", "　", "2024-01-02 ")], "encounter string, amount string, ward string, birth_date string")
    rows, own = resolve.parsed(staged.withColumn("_source_row", F.lit(1)), resolve.resolve(schema(), staged.columns))
    assert sorted(own.stripped) == sorted(staged.columns)  # one column of stripped text for each raw one
    got = rows.select(*[own.of(c).alias(c.name) for c in own.schema.all_columns() if own.has(c) and not c.crosswalk]).first().asDict()
    assert (got["visit_id"], got["amount"], got["ward"], got["birth_year"]) == ("1", 2.5, None, 2024)


@pytest.mark.parametrize("at, value", [(None, None), ((0, 8), "abc"), ((2, 4), " "), ((0, 5), "Roof"), ((1, 3), "1990-99-01")])
def test_a_parsed_source_holds_values_alone_and_counts_the_same(spark, tmp_path, at, value):
    """Text is looked at again only for columns that hold nulls."""
    rows = [list(r) for r in ROWS]
    if at:
        rows[at[0]][at[1]] = value
    staged = stage_csv(spark, export(tmp_path / "a.csv", rows))
    res = resolve.resolve(schema(), staged.columns)

    def put(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    once = checks.Parsed.of(staged, res, put)
    assert sorted(once.rows.columns) == sorted(["_source_row", *(once.rows.select(c).columns[0] for c in once.res.exprs.values())])
    assert checks.preflight(staged, res, None, "a", once) == checks.preflight(staged, res, None, "a")


def test_sums_are_exact(spark):
    values = [0.1, 0.2, -0.07, 123456.78, 1e14 + 0.25, 0.1234565, -2.5e12, None, 9999999999.99]
    df = spark.createDataFrame([(v, w) for v in values for w in (0, 1, 3)], "m double, w long")
    parts = df.agg(*[s.alias(f"p{i}") for i, s in enumerate(checks._exact_sum(F.col("m"), F.col("w")))]).first()
    assert checks._sum_of(list(parts)) == df.agg(F.sum(F.col("m").cast("decimal(38,6)") * F.col("w")).alias("s")).first()["s"]
    assert checks._sum_of([None, None, None]) is None


def test_tables_are_compared_side_by_side(spark, tmp_path, monkeypatch):
    house, both, plain = Warehouse(spark, tmp_path / "h"), threading.Barrier(2, timeout=60), checks._dimension_parity

    def waiting(rows, res, t, *rest):
        if t.name in ("dim_person", "dim_visit"):
            both.wait()  # one after the other never gets past this
        return plain(rows, res, t, *rest)

    monkeypatch.setattr(checks, "_dimension_parity", waiting)
    assert house.load(schema(), export(tmp_path / "a.csv"), "a")["ok"]


def test_stored_facts_try_no_dictionary_for_distinct_columns(spark, tmp_path):
    house = Warehouse(spark, tmp_path / "h")
    house.load(schema(), export(tmp_path / "a.csv"), "a")
    house.load(schema(), str(tmp_path / "a.csv"), "a")
    for file in (tmp_path / "h" / "tables" / "fact_results").rglob("*.parquet"):
        groups = pq.ParquetFile(file).metadata
        found = [groups.row_group(g).column(c) for g in range(groups.num_row_groups) for c in range(groups.num_columns)]
        assert not [c for c in found if c.path_in_schema in ("visit_id", "_source_row") and c.has_dictionary_page]
