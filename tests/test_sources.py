"""Files of other kinds, large crosswalks, stores and plans."""

import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F

from spindle.functions import masking
from spindle.operators import cube, keys, pages, resolve, slicer
from spindle.plans.spec import CrosswalkEntry
from spindle.sources import office
from spindle.sources.dictionary import by_field, load_dictionary, load_eda, pooled, small_profile, split_values
from spindle.sources.staging import data_entries, read_entry, read_text, stage_csv
from spindle.sources.storage import Store, shared_dir

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINK = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(path, sheets, hidden=()):
    """Cells: text as shared or inline strings, numbers, and ``("day", n)`` as dates."""
    shared = []

    def cell(row, i, v):
        at = f"{chr(65 + i)}{row}"
        if v is None:
            return ""
        if isinstance(v, tuple):
            return f'<c r="{at}" s="1"><v>{v[1]}</v></c>'
        if isinstance(v, bool):
            return f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{at}"><v>{v}</v></c>'
        if len(v) % 2:
            return f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
        shared.append(v)
        return f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'

    with zipfile.ZipFile(path, "w") as z:
        state = lambda n: ' state="hidden"' if n in hidden else ""
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"{state(n)}/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f"<workbook {MAIN} {LINK}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>' for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")
        texts = "".join(f"<si><t>{s}</t></si>" for s in shared)
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{texts}</sst>")
    return path


def document(path, table):
    word = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    rows = "".join(f"<w:tr>{''.join(map(cell, r))}</w:tr>" for r in table)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {word}><w:body><w:p><w:r><w:t>About</w:t></w:r></w:p><w:tbl>{rows}</w:tbl></w:body></w:document>")
    return path


def test_workbooks(spark, tmp_path):
    sheets = {"visits": [["id", "day", "seen", "note"], ["a1", ("day", 45292), True, None], [7, ("day", 45292.5), False, "odd"]], "notes": [["x"], ["y"]], "old": [["z"]]}
    workbook(tmp_path / "book.xlsx", sheets, hidden=("old",))
    workbook(tmp_path / "one.xlsx", {"only": [["a"], ["b"]]})
    (tmp_path / ".hidden.csv").write_text("a\n1\n")
    assert [e.rpartition("/")[2] for e in data_entries(tmp_path)] == ["book.xlsx#visits", "book.xlsx#notes", "one.xlsx"]
    rows = read_entry(spark, f"{tmp_path}/book.xlsx#visits").collect()
    assert [tuple(r) for r in rows] == [("a1", "2024-01-01", "true", None), ("7", "2024-01-01 12:00:00", "false", "odd")]
    assert read_entry(spark, f"{tmp_path}/one.xlsx").first()["a"] == "b"
    with pytest.raises(KeyError):
        list(office.sheet_rows(tmp_path / "book.xlsx", "none"))


def test_dictionaries_of_any_kind(tmp_path):
    document(tmp_path / "d.docx", [["Variable Name", "Definition", "Format", "Codes"], ["sex", "Sex at birth", "text", "F; M"], ["", "", "", ""]])
    assert load_dictionary(tmp_path / "d.docx") == [{"name": "sex", "description": "Sex at birth", "declared_type": "text", "allowed_values": ["F", "M"]}]
    workbook(tmp_path / "d.xlsx", {"about": [["Study of wards"]], "vars": [[None, None], ["Field", "Units"], ["age", "years"]]})
    assert load_dictionary(tmp_path / "d.xlsx") == [{"name": "age", "units": "years"}]
    (tmp_path / "d.yaml").write_text("variables:\n  ward:\n    label: The ward\n    codes: {1: A, 2: B}\n")
    assert load_dictionary(tmp_path / "d.yaml")[0]["allowed_values"] == ["1", "2"]
    assert split_values(["a ", 2]) == ["a", "2"] and split_values("a,b;c") == ["a,b", "c"] and split_values(None) == []
    assert by_field({"Label": "x", "Description ": "y", "other": 1}, {"d": ("description", "label")}) == {"d": "y"}


def test_profiles_of_any_kind(tmp_path):
    rows = [{"Column": "age", "dtype": "int64", "N": "30", "n_missing": "3", "pct_missing": "10%", "unique": "20", "Minimum": "1", "maximum": "90", "avg": "33.5"}]
    rows.append({"Column": "ward", "dtype": "text", "top_values": "A:b:20|C:8", "suppressed_rows": "2", "nulls": "?"})
    out = small_profile(rows)
    assert out["rows"] == 30 and out["variables"][0]["stats"] == {"null_count": 3, "null_pct": 10, "distinct_count": 20, "min": 1, "max": 90, "mean": 33.5}
    assert out["variables"][1]["stats"] == {"categories": {"A:b": 20, "C": 8}, "suppressed_categories": {"rows": 2}}
    workbook(tmp_path / "e.xlsx", {"eda": [["Variable", "rows", "missing_pct", "distinct"], ["id", 30, 0, 30]]})
    assert load_eda(tmp_path / "e.xlsx")["variables"][0]["stats"] == {"null_pct": 0, "distinct_count": 30}
    assert pooled({"A": 9, "B": 1, "C": 2}, 5) == {"categories": {"A": 9}, "suppressed_categories": {"labels": 2, "rows": 3}}


def test_crosswalks_of_thousands_of_entries(spark):
    entries = [CrosswalkEntry(f" Label  {i}", f"m{i}") for i in range(5000)] + [CrosswalkEntry("label 7", "again"), CrosswalkEntry("LABEL 8", "own", "S"), CrosswalkEntry("label 8", "late", "s ")]
    df = spark.range(6000).selectExpr("concat('LABEL ', id) as l", "if(id % 2 = 0, 's', null) as s")
    case = df.select("l", "s", resolve.crosswalk_column(F.col("l"), entries, F.col("s")).alias("v"))
    join = resolve.crosswalk_join(df, F.col("l"), entries, "v", F.col("s")).select("l", "s", "v")
    rows = {r["l"]: r["v"] for r in case.collect()}
    assert rows["LABEL 7"] == "m7" and rows["LABEL 8"] == "own" and rows["LABEL 4999"] == "m4999" and rows["LABEL 5000"] is None
    assert join.count() == 6000 and case.exceptAll(join).count() == 0


def test_numbers_without_gaps(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 as a", "id as b").repartition(5)
    got = [r["b"] for r in keys.numbered(df, ["a", "b"]).orderBy("n").collect()]
    assert got == sorted(range(1000), key=lambda b: (b % 7, b))
    assert keys.numbered(df.limit(0), ["a"]).count() == 0
    (tmp_path / "x.csv").write_text("a\n" + "\n".join(map(str, range(500))))
    for multi in (True, False):
        rows = stage_csv(spark, str(tmp_path / "x.csv"), multi).collect()
        assert sorted((r["_source_row"], r["a"]) for r in rows) == [(i + 1, str(i)) for i in range(500)]
    assert read_text(spark, str(tmp_path / "x.csv"), False).count() == 500


def test_store(spark, tmp_path):
    store, path = Store(spark), f"{tmp_path}/s/é.txt"
    store.create(path, "grün\n")
    assert store.read(path) == "grün\n" and store.children(f"{tmp_path}/s") == ["é.txt"] and store.children(f"{tmp_path}/none") == []
    assert store.is_file(path) and not store.is_file(f"{tmp_path}/s") and store.sha256(path) == hashlib.sha256("grün\n".encode()).hexdigest()
    with pytest.raises(FileExistsError):
        store.create(path, "other")
    assert store.read(path) == "grün\n" and store.children(f"{tmp_path}/s") == ["é.txt"]
    store.remove(path)
    assert not store.exists(path) and shared_dir(spark)


def test_pages_of_every_row(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (1, "x " * 1100), (1, " \n")], "id long, text string")
    rows = sorted((r["pages"], r["words"], r["long"]) for r in pages.document_summary(df, "id", "text").collect())
    assert rows == [(1, 0, False), (1, 0, False), (1, 2, False), (3, 1100, False)]
    assert pages.pages(df, "id", "text").count() == 6


def test_pivots_and_slices(spark):
    df = spark.range(60).selectExpr("id % 3 as r", "id % 4 as c", "cast(id as double) as x", "if(id % 5 = 0, null, id % 2) as d")
    wide = {r["r"]: r.asDict() for r in cube.pivot(df, "r", "c", "sum(x)", suffix="sum").collect()}
    assert wide[1]["2_sum"] == sum(i for i in range(60) if i % 3 == 1 and i % 4 == 2)
    with pytest.raises(ValueError, match="more than 3"):
        cube.pivot(df, "r", "c", most=3)
    for metric in ("count(1)", "sum(x)", "max(x)", "count(x)"):
        plain = slicer.cells(df, ["r", "c", "d"], 1, 2, metric=F.expr(metric))
        assert slicer.cells(df, ["r", "c", "d"], 1, 2, metric=metric).exceptAll(plain).count() == 0


@pytest.mark.parametrize("text, want", [
    ("patient's first name: Ann O'Tim; fever", "patient's first name: <REDACTED_PATIENT_NAME>; fever"),
    ("Name of client: Bo", "Name of client: <REDACTED_PATIENT_NAME>"), ("Patient: X came", "Patient: X came"),
    ("pt name - Kato Ben Lee Joy Five\nnext", "pt name - <REDACTED_PATIENT_NAME> Five\nnext"), ("Patient: Ann Age: 5", "Patient: <REDACTED_PATIENT_NAME> Age: 5"),
    ("seen by Dr. K. Muwonge today", "seen by <REDACTED_PATIENT_NAME> today"), ("Nurse on call", "Nurse on call"), ("Signed: KM", "Signed: <REDACTED_CLINICIAN>"),
    ("Doctor Mulago Clinic", "Doctor Mulago Clinic"), ("impatient: yes", "impatient: yes"), ("", ""),
])
def test_names(spark, text, want):
    assert spark.range(1).select(masking.mask_names(F.lit(text)).alias("t")).first()["t"] == want
