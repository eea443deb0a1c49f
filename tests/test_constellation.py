"""Specs, loads, checks, matching, extension and generation, on generated exports."""

import csv
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from spindle.functions import masking
from spindle.functions.types import canonical, compatible, plain_label, plain_name, safe_cast
from spindle.operators import checks, keys, merge, resolve, synthetic, vocabulary
from spindle.operators.graph import JoinGraph
from spindle.operators.profile import profile
from spindle.plans import extend, match, runs
from spindle.plans.registry import Registry, constellation, markdown, svg
from spindle.plans.spec import CrosswalkEntry, SpecError, parse
from spindle.sources.dictionary import load_dictionary, load_eda, merge_sources, split_values, write_eda
from spindle.sources.staging import entry_stem, split_entry, stage_csv
from spindle.sources.warehouse import LoadRefused, Warehouse


def spec(**over):
    data = {
        "schema_id": "lab", "spine": {"table": "dim_visit", "key": "visit_id"}, "main_fact": "fact_results",
        "tables": {
            "dim_person": {"kind": "dimension", "key": "person_id", "synthetic": {"rows": 12}, "columns": {
                "person_id": {"type": "VARCHAR", "role": "key", "required": True, "pii": True, "aliases": ["subject"]},
                "sex": {"type": "VARCHAR", "allowed": ["Female", "Male"]},
                "birth_year": {"type": "BIGINT", "expr": "year(try_cast(birth_date as date))", "inputs": ["birth_date"]}}},
            "dim_visit": {"kind": "dimension", "key": "visit_id", "links": ["dim_person"], "columns": {
                "visit_id": {"type": "VARCHAR", "role": "key", "required": True, "aliases": ["encounter"]},
                "visit_date": {"type": "DATE", "required": True}, "ward": {"type": "VARCHAR"}, "site": {"type": "VARCHAR"},
                "ward_kind": {"type": "VARCHAR", "crosswalk": {"file": "wards", "from": "ward", "scope": "site"}}}},
            "dim_drug": {"kind": "dimension", "key": "drug", "columns": {"drug": {"type": "VARCHAR", "role": "key", "required": True, "keep_as": "drug_code"}}},
            "fact_results": {"kind": "fact", "links": ["dim_drug"], "grain": ["visit_id", "drug"], "columns": {
                "amount": {"type": "DOUBLE", "role": "measure", "range": [0, 100]}, "outcome": {"type": "VARCHAR", "allowed": ["S", "I", "R"]}}},
        },
        "excluded_variables": {"comment": "free text"},
    }
    return data | over


ROWS = [
    ("V1", "P1", "Female", "1990-05-01", "2024-01-02", "Pediatric", "A", "D1", "1.5", "S", "x"),
    ("V1", "P1", "Female", "1990-05-01", "2024-01-02", "Pediatric", "A", "D2", "2.5", "R", "x"),
    ("V2", "P2", "Male", "", "2024-01-03", " ward  4B ", "B", "D1", "3.0", "S", ""),
    ("V3", "P1", "", "1990-05-01", "2024-01-04", "WARD 4b", "A", "D1", "", "I", ""),
    ("V3", "P1", "", "1990-05-01", "2024-01-04", "WARD 4b", "A", "D1", "", "I", ""),
]
HEADER = ["encounter", "subject", "sex", "birth_date", "visit_date", "ward", "site", "drug", "amount", "outcome", "comment"]
WALK = {"wards": [CrosswalkEntry("pediatric", "Children"), CrosswalkEntry("Ward 4B", "Surgery"), CrosswalkEntry("ward 4b", "Medicine", "b")]}


def schema():
    out = parse(spec())
    out.crosswalks = dict(WALK)
    return out


def export(path, rows=ROWS, header=HEADER):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


def failed(summary):
    return {(r["check"], r["target"]): r["actual"] for r in summary["results"] if not r["passed"]}


def test_names_and_types():
    assert plain_name(" Visit-Date (d) ") == "visit_date_d"
    assert plain_label("  Ward \t 4B ") == "ward 4b"
    assert [canonical(t) for t in ("decimal(10,2)", "int", "datetime", "blob", None)] == ["DOUBLE", "BIGINT", "TIMESTAMP", None, None]
    assert compatible("BIGINT", "BOOLEAN") and compatible("DATE", "VARCHAR") and not compatible("DOUBLE", "DATE")
    assert compatible("BOOLEAN", None) and not compatible("BIGINT", "DOUBLE")


@pytest.mark.parametrize(
    "text, kind, want",
    [
        ("1.5", "BIGINT", None), (" 7 ", "BIGINT", 7), ("1e3", "BIGINT", None), (" 8", "BIGINT", 8), ("1d", "DOUBLE", None), ("1.5", "DOUBLE", 1.5),
        ("2025", "DATE", None), ("2025-01", "DATE", None), ("2025/01/02", "DATE", "2025-01-02"), ("2025-1-2", "DATE", "2025-01-02"), ("2025-02-30", "DATE", None),
        ("yes", "BOOLEAN", True), ("maybe", "BOOLEAN", None), ("   ", "VARCHAR", None), (" a ", "VARCHAR", "a"), (None, "DOUBLE", None),
        ("2025/01/02 10:20:30", "TIMESTAMP", "2025-01-02 10:20:30"),
    ],
)
def test_strict_casts(spark, text, kind, want):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(safe_cast(F.col("t"), kind).alias("v")).first()["v"]
    assert (str(got) if isinstance(want, str) and kind != "VARCHAR" else got) == want


def test_compat_casts(spark):
    df = spark.createDataFrame([("1.5",), ("2.5",), ("-1.5",), ("1e3",), ("x",)], "t string")
    assert [r.v for r in df.select(safe_cast(F.col("t"), "BIGINT", compat=True).alias("v")).collect()] == [2, 3, -2, 1000, None]


@pytest.mark.parametrize(
    "change, words",
    [
        (lambda d: d["tables"]["fact_results"]["columns"]["amount"].update(type="VARCHAR"), "measures must be numeric"),
        (lambda d: d.update(main_fact="dim_drug"), "no fact"),
        (lambda d: d.pop("spine"), "missing: spine"),
        (lambda d: d.update(schema_id="Lab 1"), "snake_case"),
        (lambda d: d["tables"]["dim_drug"].update(links=["dim_nothing"]), "no dimension"),
        (lambda d: d["tables"]["dim_person"].update(links=["dim_visit"]), "cycle"),
        (lambda d: d["tables"]["fact_results"].update(grain=["nothing"]), "not stored"),
        (lambda d: d["tables"]["dim_visit"]["columns"]["ward"].update(aliases=["sex"]), "feeds both"),
        (lambda d: d["tables"]["dim_person"]["columns"]["person_id"].update(keep_as="code"), "without pii"),
        (lambda d: d["tables"]["dim_person"]["columns"]["birth_year"].pop("inputs"), "needs inputs"),
        (lambda d: d["tables"]["dim_visit"]["columns"].update(_source_id={"type": "VARCHAR"}), "reserved"),
        (lambda d: d["tables"]["dim_visit"]["columns"]["ward_kind"].update(aliases=["w"]), "crosswalk excludes"),
        (lambda d: d["tables"]["dim_drug"]["columns"].update(drug_code={"type": "VARCHAR"}), "is a column already"),
    ],
)
def test_spec_faults(change, words):
    data = spec()
    change(data)
    with pytest.raises(SpecError, match=words):
        parse(data)


def test_yaml_round_trip():
    assert parse(schema().to_dict()).to_dict() == schema().to_dict()
    assert "drug_code" in schema().tables["dim_drug"].columns


def test_load(spark, tmp_path):
    house = Warehouse(spark, tmp_path / "house")
    s = schema()
    summary = house.load(s, export(tmp_path / "a.csv"), "Site A")
    assert summary["ok"] and not failed(summary)
    visits = {r["ward"]: r["ward_kind"] for r in house.read("dim_visit").collect()}
    assert visits == {"Pediatric": "Children", "ward  4B": "Medicine", "WARD 4b": "Surgery"}
    people = house.read("dim_person").collect()
    assert sorted(r["person_id"] for r in people) == ["PER-000001", "PER-000002"]
    assert {r["person_id"]: (r["sex"], r["birth_year"]) for r in people} == {"PER-000001": ("Female", 1990), "PER-000002": ("Male", None)}
    facts = house.read("fact_results")
    assert facts.count() == 4 and facts.agg(F.sum("amount")).first()[0] == 7.0
    assert {r["drug_code"]: r["drug"] for r in house.read("dim_drug").collect()} == {"D1": "DRU-000001", "D2": "DRU-000002"}
    # The same source again: nothing changes.
    before = {n: sorted(map(str, house.read(n).drop("loaded_at").collect())) for n in house.names()}
    house.load(s, export(tmp_path / "a.csv"), "Site A")
    assert before == {n: sorted(map(str, house.read(n).drop("loaded_at").collect())) for n in house.names()}
    # Another source: keys go on, gaps are filled, its facts stand beside.
    rows = [("V9", "P3", "Male", "2001-01-01", "2024-02-01", "pediatric", "C", "D3", "4", "S", ""), ("V2", "P2", "Male", "1970-01-01", "2024-01-03", "ward 4b", "B", "D1", "3", "S", "")]
    summary = house.load(s, export(tmp_path / "b.csv", rows), "site b")
    assert summary["ok"]
    assert {r["person_id"]: r["birth_year"] for r in house.read("dim_person").collect()}["PER-000002"] == 1970
    assert house.read("fact_results").count() == 6 and house.read("dim_data_source").count() == 2
    assert house.check(s, "Site A")["ok"]
    assert {r["table_name"]: r["rows"] for r in house.table_counts().collect()}["fact_results"] == 6
    assert house.query("select count(*) as n from fact_results").first()["n"] == 6
    assert not [n for n in house.names() if n.startswith("stg_") or n == "key_map"]
    out = runs.run_pipeline(house, s, ["Site A"])
    assert out["checks"]["Site A"]["ok"] and out["latency"]["rows"] == 1


@pytest.mark.parametrize(
    "at, value, check, target, blocks",
    [
        ((0, 0), "  ", "spine_key_nulls", "dim_visit.visit_id", True),
        ((0, 8), "N/A", "cast_failures", "fact_results.amount", True),
        ((2, 3), "UNKNOWN", "derived_completeness", "dim_person.birth_year", True),
        ((0, 5), "Roof", "crosswalk_coverage", "dim_visit.ward_kind", True),
        ((0, 9), "Z", "allowed_values", "fact_results.outcome", False),
        ((0, 8), "101", "value_range", "fact_results.amount", False),
        ((2, 4), "", "required_nulls", "dim_visit.visit_date", False),
        ((1, 2), "Male", "entity_consistency", "dim_person", False),
        ((4, 9), "R", "fact_grain", "fact_results", True),
    ],
)
def test_each_fault_is_counted_once(spark, tmp_path, at, value, check, target, blocks):
    rows = [list(r) for r in ROWS]
    rows[at[0]][at[1]] = value
    staged = stage_csv(spark, export(tmp_path / "a.csv", rows))
    summary = checks.summarize(checks.preflight(staged, resolve.resolve(schema(), staged.columns)))
    assert failed(summary)[(check, target)] == 1
    assert summary["ok"] == (not blocks)


def test_refusal_and_unmapped(spark, tmp_path):
    house = Warehouse(spark, tmp_path / "h")
    rows = [(*r, "1") for r in ROWS]
    with pytest.raises(LoadRefused, match="variable_coverage"):
        house.load(schema(), export(tmp_path / "a.csv", rows, [*HEADER, "extra"]), "a")
    assert house.names() == []
    assert house.load(schema(), str(tmp_path / "a.csv"), "a", force=True)["failed"] == 1


def test_stored_mutation_is_found(spark, tmp_path):
    house, s = Warehouse(spark, tmp_path / "h"), schema()
    house.load(s, export(tmp_path / "a.csv"), "a")
    broken = house.read("fact_results").withColumn("amount", F.when(F.col("amount") == 1.5, 2.5).otherwise(F.col("amount")))
    house.write("fact_results", spark.createDataFrame(broken.collect(), broken.schema), by_source=True)
    found = failed(house.check(s, "a"))
    assert found[("value_parity", "fact_results")] == 2 and ("measure_sum_parity", "fact_results.amount") in found


def test_stored_types_are_kept(spark, tmp_path):
    house = Warehouse(spark, tmp_path / "h")
    house.load(schema(), export(tmp_path / "a.csv"), "a")
    data = spec()
    data["tables"]["dim_visit"]["columns"]["visit_date"]["type"] = "TIMESTAMP"
    changed = parse(data)
    changed.crosswalks = dict(WALK)
    with pytest.raises(TypeError):
        house.load(changed, str(tmp_path / "a.csv"), "a")


def test_keys_beyond_six_digits(spark):
    naturals = spark.range(3).selectExpr("cast(id as string) natural_key", "id first_row")
    old = spark.range(1).selectExpr("'dim_x' dimension", "'a' natural_key", "'X-1' surrogate_key", "'s' source_id")
    got = keys.new_keys(naturals, old, "dim_x", "t").orderBy("natural_key").collect()
    assert [r.surrogate_key for r in got] == ["X-000002", "X-000003", "X-000004"] and keys.key_prefix("dim_patient") == "PAT"


def test_merge_edges(spark):
    empty = spark.createDataFrame([], "k string, a long, _source_row long")
    assert merge.first_values(empty, "k").count() == 0
    df = spark.createDataFrame([("x", None, 1), ("x", 5, 3), ("x", 4, 2), (None, 9, 1), ("y", None, 4)], empty.schema)
    assert {r.k: r.a for r in merge.first_values(df, "k").collect()} == {"x": 4, "y": None}
    assert merge.difference_count(df, df).first()["mismatches"] == 0
    assert merge.difference_count(df, df.limit(0)).first()["mismatches"] == 5


def test_graph():
    graph = JoinGraph.of(schema())
    assert graph.path("fact_results", "dim_person") == ["fact_results", "dim_visit", "dim_person"]
    assert graph.joins("fact_results", "dim_drug") == 1 and graph.joins("fact_results", "nowhere") == -1
    assert "JOIN dim_visit ON fact_results.visit_id = dim_visit.visit_id" in graph.sql("fact_results", "dim_person")
    with pytest.raises(ValueError):
        graph.add("a", "b", "")


def test_match_extend_attach(tmp_path):
    registry = Registry(tmp_path)
    (tmp_path / "crosswalks").mkdir()
    (tmp_path / "crosswalks" / "wards.yaml").write_text("entries:\n- {value: Pediatric, maps_to: Children}\n")
    registry.save(parse(spec()))
    variables = [{"name": n, "type": "VARCHAR"} for n in HEADER if n not in ("amount", "comment")] + [{"name": "amount", "type": "DOUBLE"}]
    fit = match.match(variables, registry.get("lab"))
    assert fit["decision"] == "fit" and fit["difference"] == 0
    more = [*variables, {"name": "viral_load", "type": "DOUBLE"}]
    assert match.match_all(more, registry.all())["decision"] == "extend"
    assert match.match([{"name": "a"}, {"name": "b"}], registry.get("lab"))["decision"] == "new_schema"
    gaps = match.match([*variables[:-1], {"name": "amount", "type": "DATE"}], registry.get("lab"))
    assert gaps["type_conflicts"] and gaps["decision"] == "extend"
    patch = {"reason": "viral load", "add_tables": {"fact_viral": {"kind": "fact", "grain": ["visit_id"], "columns": {"viral_load": {"type": "DOUBLE", "role": "measure"}}}}, "add_aliases": {"dim_visit.ward": ["unit"]}}
    with pytest.raises(SpecError, match="placement"):
        extend.extend("lab", patch, registry, {"placement": "own_mart"})
    patched = extend.extend("lab", patch, registry, {"placement": "extend"})
    assert match.match(more, registry.get("lab"))["decision"] == "fit" and len(patched.changelog) == 1
    for bad in ({"reason": "x"}, {"add_links": {}}, {"reason": "x", "remove": 1}, {"reason": "x", "add_columns": {"dim_visit": {"ward": {"type": "VARCHAR"}}}}):
        with pytest.raises(SpecError):
            extend.apply_patch(patched, bad)
    fed = extend.attach_dataset(patched, "Round 1", more, "c.csv", "e.yaml")
    assert "dim_visit.ward_kind" in fed and "dim_drug.drug_code" in fed and patched.datasets["round_1"]["columns_fed"] == len(fed)
    registry.save(patched)
    view = constellation(registry, "round_1")
    assert view["spines"] == ["dim_visit"] and "**fact_viral**" in markdown(view)
    drawn = ElementTree.fromstring(svg(view))
    assert len(drawn.findall("{*}line")) == len(view["relationships"]) and len(drawn.findall("{*}g")) == len(view["tables"])
    other = spec(schema_id="other")
    other["tables"]["dim_visit"]["columns"]["visit_date"]["type"] = "TIMESTAMP"
    with pytest.raises(SpecError, match="type differs"):
        registry.save(parse(other))


def test_synthetic_round_trip(spark, tmp_path):
    s = schema()
    df = synthetic.generate(spark, s, visits=60, seed=3)
    assert df.count() <= 400 and df.collect() == synthetic.generate(spark, s, visits=60, seed=3).collect()
    assert synthetic.generate(spark, s, visits=5000).count() <= 400
    path = tmp_path / "dummy.csv"
    pdf = df.toPandas()
    pdf["ward"], pdf["site"] = "Pediatric", "A"
    pdf.drop_duplicates(["visit_id", "drug"]).to_csv(path, index=False)
    summary = Warehouse(spark, tmp_path / "h").load(s, str(path), "dummy", synthetic=True)
    assert summary["ok"], failed(summary)
    shaped = synthetic.generate(spark, s, 300, eda={"variables": [{"name": "outcome", "stats": {"categories": {"R": 90, "S": 10}, "null_pct": 0}}]})
    counts = {r["outcome"]: r["count"] for r in shaped.groupBy("outcome").count().collect()}
    assert counts["R"] > 5 * counts["S"] and "I" not in counts


def test_profile_files(spark, tmp_path):
    df = spark.createDataFrame([(str(i), "A" if i < 9 else "Rare", float(i)) for i in range(10)], "id string, ward string, x double")
    eda = profile(df, max_categories=5)
    ward = next(v for v in eda["variables"] if v["name"] == "ward")["stats"]
    assert ward["categories"] == {"A": 9} and ward["suppressed_categories"] == {"labels": 1, "rows": 1}
    assert next(v for v in eda["variables"] if v["name"] == "id")["stats"]["unique_per_row"]
    for name in ("e.yaml", "e.csv"):
        write_eda(eda, tmp_path / name)
        back = load_eda(tmp_path / name)
        assert [v["name"] for v in back["variables"]] == ["id", "ward", "x"]
        assert next(v for v in back["variables"] if v["name"] == "ward")["stats"]["categories"] == {"A": 9}
    (tmp_path / "d.csv").write_text("Field Name,Label,Data Type,Codes\nward,The ward,text,A|B\nid,,int,\n")
    dictionary = load_dictionary(tmp_path / "d.csv")
    assert dictionary[0]["allowed_values"] == ["A", "B"] and dictionary[0]["declared_type"] == "text"
    assert next(v for v in merge_sources(eda, dictionary) if v["name"] == "ward")["description"] == "The ward"
    assert split_values("a; b") == ["a", "b"] and split_values("") == []
    assert split_entry("b.xlsx#S 1") == ("b.xlsx", "S 1") and entry_stem("d/b.xlsx#S 1") == "b__S_1"


def test_vocabulary(spark, tmp_path):
    df = spark.createDataFrame([(f"v{i}", "w") for i in range(60)], "name string, site string")
    with pytest.raises(vocabulary.VocabularyError, match="free text"):
        vocabulary.label_counts([df], "name")
    with pytest.raises(vocabulary.VocabularyError, match="identifier"):
        vocabulary.label_counts([df], "name", identifiers=["Name"])
    with pytest.raises(vocabulary.VocabularyError, match="no file"):
        vocabulary.label_counts([df], "nothing")
    path = tmp_path / "w.yaml"
    assert vocabulary.merge_crosswalk(path, "w", "ward", ["A", "B"])["unmapped"] == 2
    path.write_text(path.read_text().replace("maps_to: ''", "maps_to: X", 1))
    again = vocabulary.merge_crosswalk(path, "w", "ward", [" a ", "C"])
    assert again["added"] == ["C"] and again["unmapped"] == 2


def test_large_crosswalk_equals_cases(spark):
    df = spark.createDataFrame([(" A ", "s"), ("a", "t"), ("b", "s"), (None, "s"), ("z", None)], "l string, s string")
    entries = [CrosswalkEntry("a", "general"), CrosswalkEntry("A", "own", "S"), CrosswalkEntry("b", "bee")]
    case = df.select("l", "s", resolve.crosswalk_column(F.col("l"), entries, F.col("s")).alias("v"))
    join = resolve.crosswalk_join(df, F.col("l"), entries, "v", F.col("s"))
    assert sorted(map(str, case.collect())) == sorted(map(str, join.select("l", "s", "v").collect()))


def test_masking(spark):
    texts = ["Patient name: John Kato seen", "Dr. Okello came", "Patient: Mulago Hospital", "Clinician: Anna Bee", None, "Nurse Kampala kept"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.m for r in df.select(masking.mask(F.col("t"), ["Kampala"]).alias("m")).collect()]
    assert got[0].startswith("Patient name: <REDACTED_PATIENT_NAME>") and got[1] == "<REDACTED_PATIENT_NAME> came"
    assert got[2] == texts[2] and got[3] == "Clinician: <REDACTED_CLINICIAN>" and got[4] == "" and got[5] == texts[5]


def test_inventory(spark, tmp_path):
    staged = stage_csv(spark, export(tmp_path / "a.csv"))
    inventory = runs.FieldInventory(resolve.resolve(schema(), staged.columns))
    assert inventory.left_out() == [] and inventory.switch("sex", "dim_visit").table == "dim_visit"


def test_quoted_csv(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b\n"x, y","line 1\nline 2"\n" p ",""\n"say ""hi""",z\n')
    rows = stage_csv(spark, str(path)).collect()
    assert [r["_source_row"] for r in rows] == [1, 2, 3]
    assert rows[0]["b"] == "line 1\nline 2" and rows[2]["a"] == 'say "hi"' and not rows[1]["b"]


def test_stream(spark, tmp_path):
    from pyspark.sql import types as T

    from spindle.streaming import incremental

    source, kind = tmp_path / "in", T.StructType().add("k", "long").add("v", "string")
    spark.createDataFrame([(1, "a"), (2, None), (2, "b")], kind).coalesce(1).write.parquet(str(source))
    stream = lambda: incremental.read_files(spark, str(source), kind)
    run = lambda: incremental.append_new(stream(), str(tmp_path / "out"), ["k"], str(tmp_path / "cp")).awaitTermination(60)
    run()
    spark.createDataFrame([(2, "c"), (3, "d")], kind).coalesce(1).write.mode("append").parquet(str(source))
    run()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
    incremental.merge_into(stream(), str(tmp_path / "dim"), "k", str(tmp_path / "cp2")).awaitTermination(60)
    got = {r.k: r.v for r in spark.read.parquet(str(tmp_path / "dim/v0")).collect()}
    assert got[1] == "a" and got[3] == "d" and got[2] in ("b", "c")


def test_description(spark, tmp_path):
    from spindle.plans import describe

    export(tmp_path / "visits.csv")
    (tmp_path / "codes.csv").write_text("code,label\n1,a\n2,b\n")
    (tmp_path / "protocol.txt").write_text(" ".join(["word"] * 600 + ["cohort"] + ["word"] * 1200 + ["primary objective"] + ["word"] * 400))
    out = describe.describe(spark, tmp_path, "round1", {"study.main_question": "why"}, ("codes.csv",), ("protocol.txt",))
    assert [f["file"] for f in out["dataset"]["files"]] == ["visits.csv"] and (tmp_path / "visits_eda.yaml").exists()
    assert out["codes_and_vocabularies"] == [{"file": "codes.csv", "entries": 2}]
    assert out["documents"][0]["pages"] == 5 and out["documents"][0]["concept_pages"]["study.study_type"] == [2]
    assert out["documents"][0]["concept_pages"]["study.main_question"] == [4]
    assert "study.main_question" not in describe.empty_fields(out) and "study.description" in describe.empty_fields(out)
    with pytest.raises(ValueError, match="outside"):
        describe.inside(tmp_path, "../x")


def test_command_line(spark, tmp_path, capsys):
    import json

    from spindle.__main__ import main

    (tmp_path / "crosswalks").mkdir()
    (tmp_path / "crosswalks" / "wards.yaml").write_text("entries:\n- {value: Pediatric, maps_to: Children}\n- {value: ward 4b, maps_to: Surgery}\n")
    Registry(tmp_path).save(parse(spec()))
    call = lambda *a: (main([str(x) for x in a]), json.loads(capsys.readouterr().out))
    assert call("schemas", tmp_path)[1][0]["schema_id"] == "lab"
    assert call("validate", tmp_path / "lab.yaml")[1]["valid"]
    data = export(tmp_path / "site.csv")
    code, out = call("load", tmp_path, "lab", data, tmp_path / "h", "--source", "s1")
    assert code == 0 and out["ok"]
    assert call("query", tmp_path / "h", "select count(*) as n from fact_results")[1] == [{"n": 4}]
    assert call("check", tmp_path, "lab", "s1", tmp_path / "h")[1]["ok"]
    assert call("eda", data, tmp_path / "h" / "eda.yaml")[1]["rows"] == 5
    assert call("match", tmp_path, "--eda", tmp_path / "h" / "eda.yaml")[1]["best"] == "lab"
    assert call("extend", tmp_path, "lab", tmp_path / "lab.yaml")[0] == 1
