"""Generated data-quality checks.

Row-level checks of one source are one aggregation over the staged table, whatever the
number of columns; grouped checks are one pass per table.  Results carry counts, never
values of rows, except unmapped labels of a vocabulary that is not marked as personal.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from decimal import Decimal
from functools import partial, reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.types import TEXT, trimmed
from spindle.operators.merge import difference_count, first_values, fold_facts
from spindle.operators.resolve import Resolution, fact_rows, parsed, typed
from spindle.operators.together import together
from spindle.plans.spec import SOURCE_ID, SOURCE_ROW, Column, Schema, Table

TOLERANCE = 1e-6
LABELS_LISTED = 50
RESULT = "check string, target string, passed boolean, expected string, actual string, detail string, phase string, severity string"


@dataclass
class Result:
    check: str
    target: str
    passed: bool
    expected: Any = None
    actual: Any = None
    detail: str = ""
    phase: str = "preflight"
    severity: str = "error"


def as_frame(spark: SparkSession, results: Iterable[Result]) -> DataFrame:
    text = lambda v: None if v is None else str(v)
    rows = [(r.check, r.target, r.passed, text(r.expected), text(r.actual), r.detail, r.phase, r.severity) for r in results]
    return spark.createDataFrame(rows, RESULT)


def summarize(results: list[Result]) -> dict[str, Any]:
    """Counts by outcome; only failed errors block."""
    failed = [r for r in results if r.severity == "error" and not r.passed]
    issues = [r for r in results if r.severity == "data_issue" and not r.passed]
    return {
        "total": len(results), "passed": sum(r.passed for r in results), "failed": len(failed), "data_issues": len(issues),
        "ok": not failed, "results": [asdict(r) for r in results],
    }


# --- single checks, usable on any DataFrame ---------------------------------------------


def count_where(condition) -> Any:
    return F.count(F.when(condition, F.lit(1)))


def outside_values(c, allowed) -> Any:
    return c.isNotNull() & ~c.isin(*allowed)


def outside_range(c, low, high) -> Any:
    """Beyond either bound; a bound of None is open."""
    out = F.lit(False)
    if low is not None:
        out = out | (c < F.lit(low))
    if high is not None:
        out = out | (c > F.lit(high))
    return c.isNotNull() & out


def inconsistent_keys(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """``keys`` with more than one value of any attribute, and ``n_<attribute>`` for each."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.count_distinct(F.col(a)).alias(a) for a in attributes])
    many = [F.col(a) > 1 for a in attributes]
    any_ = many[0]
    for m in many[1:]:
        any_ = any_ | m
    return per.agg(count_where(any_).alias("keys"), *[count_where(m).alias(f"n_{a}") for a, m in zip(attributes, many)])


def repeated_grain(df: DataFrame, grain: list[str]) -> DataFrame:
    """``groups``: grains that more than one distinct row shares."""
    return df.distinct().groupBy(*grain).count().where("count > 1").agg(F.count(F.lit(1)).alias("groups"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """``orphans``: child rows whose non-null key has no parent."""
    own = parent.select(F.col(parent_key or key).alias(key))
    each = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))  # a key moves once, not its rows
    return each.join(own, key, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


def coverage(spine: DataFrame, fact: DataFrame, key: str, fact_key: str | None = None) -> DataFrame:
    """``spines, covered, pct``: distinct spine keys, those the fact has, and their share
    in percent with two decimals (100 for no spine)."""
    keys = spine.select(key).where(F.col(key).isNotNull()).distinct()
    have = fact.select(F.col(fact_key or key).alias(key), F.lit(1).alias("_h")).distinct()
    seen = keys.join(have, key, "left")
    out = seen.agg(F.count(F.lit(1)).alias("spines"), F.count("_h").alias("covered"))
    return out.withColumn("pct", F.when(F.col("spines") == 0, 100.0).otherwise(F.round(F.col("covered") * 100.0 / F.col("spines"), 2)))


def sums_match(expected: float | None, actual: float | None) -> bool:
    a, b = float(expected or 0), float(actual or 0)
    return abs(a - b) <= TOLERANCE * max(1.0, abs(a))


# --- before anything is written ---------------------------------------------------------


@dataclass
class Parsed:
    """A staged source whose values were computed once."""

    rows: DataFrame
    res: Resolution  # reads the values of ``rows``
    entities: dict[str, DataFrame]  # of each dimension with a key: its distinct rows
    repeated: dict[str, DataFrame | None]  # the keys with several distinct rows; None: there are none
    firsts: dict[str, DataFrame]  # one row for each key: its first values and smallest row number

    @classmethod
    def of(cls, staged: DataFrame, res: Resolution, put) -> Parsed:
        """``put(df, name)`` writes a table and reads it back."""
        rows, own = parsed(staged, res)
        values = [n for n in rows.columns if n not in res.columns and n not in own.stripped.values()]
        out = cls(put(rows.select(*values), "rows"), own, {}, {}, {})
        dimensions = [t for t in res.schema.dimensions if res.has(t.columns[t.key])]
        for t, made in zip(dimensions, together([partial(out._made, t, put) for t in dimensions])):
            out.entities[t.name], out.repeated[t.name], out.firsts[t.name] = made
        return out

    def _made(self, t: Table, put) -> tuple[DataFrame, DataFrame | None, DataFrame]:
        """A dimension's rows, the keys that occur in several of them, and its first values, which
        are the rows themselves where no key does."""
        all_ = put(entities(self.rows, self.res, t), f"entities_{t.name}")
        many = put(repeated_keys(all_, t.key), f"repeated_{t.name}")
        if many.isEmpty():
            return all_, None, all_
        single = all_.join(many, t.key, "left_anti").select(*all_.columns)
        folded = first_values(all_.join(many, t.key, "left_semi"), t.key, keep_order=True)
        return all_, many, put(single.unionByName(folded), f"firsts_{t.name}")


def entities(staged: DataFrame, res: Resolution, t: Table) -> DataFrame:
    """The distinct rows of a dimension with a key, each with its smallest row number.  They are
    all that keys, first values and consistency need (-0.0 becomes 0.0, as in folded facts)."""
    return fold_facts(typed(staged, res, t).where(F.col(t.key).isNotNull()))


def repeated_keys(distinct: DataFrame, key: str) -> DataFrame:
    """The keys of more than one row; any other key agrees with itself."""
    return distinct.groupBy(key).count().where("count > 1").select(key)


#: A check of single rows: column, check, severity, whether its text is given (None: of no
#: concern) and the fault of its value; a row fails where both hold.
RowCheck = tuple[Column, str, str, Any, Any]


def _row_level(res: Resolution) -> list[RowCheck]:
    """The checks that are counted row by row."""
    out: list[RowCheck] = []

    def add(column: Column, check: str, severity: str, fault, given=None) -> None:
        out.append((column, check, severity, given, fault))

    for c in res.schema.all_columns():
        if not res.has(c):
            continue
        value, feeds = res.of(c), res.feeds[(c.table, c.name)]
        if c.crosswalk:
            add(c, "crosswalk_coverage", "error", value.isNull(), res.given_label(c))
        elif c.expr and c.role != "key":
            add(c, "derived_completeness", "error", value.isNull(), reduce(and_, map(res.given, feeds), F.lit(True)))
        elif c.type != TEXT and not c.expr:
            add(c, "cast_failures", "error", value.isNull(), res.given_label(c))
        if c.allowed and not c.crosswalk:
            add(c, "allowed_values", "data_issue", outside_values(value, c.allowed))
        if c.range:
            add(c, "value_range", "data_issue", outside_range(value, *c.range))
        if c.required and c.role != "key":
            add(c, "required_nulls", "data_issue", value.isNull())
    return out


def _row_counts(staged: DataFrame, res: Resolution, once: Parsed | None) -> list[int]:
    """Rows whose spine's key is null, then rows that fail each check.

    Of a parsed source the values alone are counted, in one pass.  Text is read again only for
    columns that hold nulls; of a column that is cast and no more, those that are given and null
    are the given less the values, as no value comes of a blank."""
    own = _row_level(res)
    spine = res.schema.tables[res.schema.spine_table].columns[res.schema.spine_key]
    if once is None:
        failing = [fault if given is None else given & fault for *_, given, fault in own]
        return list(staged.agg(*[count_where(c).alias(f"c{i}") for i, c in enumerate([res.of(spine).isNull(), *failing])]).first())
    faults = [once.res.of(spine).isNull(), *(fault for *_, fault in _row_level(once.res))]
    total, *counts = once.rows.agg(F.count(F.lit(1)).alias("n"), *[count_where(c).alias(f"c{i}") for i, c in enumerate(faults)]).first()
    unsure = [i for i, (*_, given, _) in enumerate(own, 1) if given is not None and counts[i]]
    if unsure:
        plain = {i for i in unsure if (own[i - 1][0].table, own[i - 1][0].name) in res.plain}
        asked = {i: given if i in plain else given & fault for i, (*_, given, fault) in enumerate(own, 1) if i in unsure}
        found = staged.agg(*[count_where(c).alias(f"c{i}") for i, c in asked.items()]).first()
        for i in unsure:
            counts[i] = found[f"c{i}"] - (total - counts[i] if i in plain else 0)
    return counts


def preflight(
    staged: DataFrame, res: Resolution, keymap: DataFrame | None = None, source_id: str = "", once: Parsed | None = None
) -> list[Result]:
    """All checks on the staged source, before any write; ``once``: the same source, parsed."""
    schema, out = res.schema, []
    out.append(Result("variable_coverage", "source", not res.unmapped, 0, len(res.unmapped), ", ".join(res.unmapped)))
    spine = schema.tables[schema.spine_table].columns[schema.spine_key]
    out.append(Result("spine_key_present", f"{spine.table}.{spine.name}", res.has(spine)))
    dimensions = [t for t in schema.dimensions if res.has(t.columns[t.key])]
    facts = [t for t in schema.facts if t.grain and res.content(t)]

    def of_dimension(t: Table) -> list[Result]:
        distinct = once.entities[t.name] if once else entities(staged, res, t)
        return _dimension_checks(distinct, once.repeated[t.name] if once else repeated_keys(distinct, t.key), res, t, keymap, source_id)

    def of_fact(t: Table) -> list[Result]:
        rows = (fact_rows(once.rows, once.res, t) if once else fact_rows(staged, res, t)).drop(SOURCE_ROW)
        n = repeated_grain(rows, t.grain).first()["groups"]
        return [Result("fact_grain", t.name, n == 0, 0, n, f"grain: {', '.join(t.grain)}")]

    jobs = [lambda: _row_counts(staged, res, once), *(partial(of_dimension, t) for t in dimensions), *(partial(of_fact, t) for t in facts)]
    (blank, *counts), *of_tables = together(jobs)
    if res.has(spine):
        out.append(Result("spine_key_nulls", f"{spine.table}.{spine.name}", blank == 0, 0, blank))
    for i, (c, check, severity, *_) in enumerate(_row_level(res)):
        n, detail = counts[i], ""
        if check == "crosswalk_coverage" and n:
            detail = _unmapped_labels(staged, res, c)
        out.append(Result(check, f"{c.table}.{c.name}", n == 0, 0, n, detail, severity=severity))
    return out + [r for results in of_tables for r in results]


def _dimension_checks(
    distinct: DataFrame, many: DataFrame | None, res: Resolution, t: Table, keymap: DataFrame | None, source_id: str
) -> list[Result]:
    """Checks of a dimension's distinct rows; ``many``: the keys with several, None for none."""
    out = []
    attributes = [c for n, c in t.columns.items() if n != t.key and c.from_key != t.key and res.has(c)]
    if attributes:
        keys, detail = 0, ""
        if many is not None:
            row = inconsistent_keys(distinct.join(many, t.key, "left_semi"), t.key, [c.name for c in attributes]).first()
            keys, detail = row["keys"], ", ".join(f"{c.name}: {row[f'n_{c.name}']}" for c in attributes if row[f"n_{c.name}"])
        out.append(Result("entity_consistency", t.name, keys == 0, 0, keys, detail, severity="data_issue"))
    if keymap is not None:
        others = keymap.where((F.col("dimension") == t.name) & ~F.col("source_id").eqNullSafe(F.lit(source_id)))
        own = distinct.select(F.col(t.key).cast("string").alias("natural_key")).distinct()
        shared = own.join(others, "natural_key", "left_semi").count()
        out.append(Result("keys_shared_with_other_sources", t.name, True, None, shared, severity="info"))
    return out


def unmapped_labels(staged: DataFrame, res: Resolution, column: Column, limit: int = LABELS_LISTED) -> DataFrame:
    """``value, scope, rows`` of labels without a standard value, the most frequent first."""
    ref = (column.table, column.name)
    scope = res.scopes.get(ref, F.lit(None).cast("string"))
    label = trimmed(res.labels[ref])
    rows = staged.where(label.isNotNull() & res.of(column).isNull()).groupBy(label.alias("value"), scope.alias("scope"))
    return rows.agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "value", "scope").limit(limit)


def _unmapped_labels(staged: DataFrame, res: Resolution, column: Column) -> str:
    label = next((c for c in res.schema.all_columns() if c.name == column.crosswalk["from"]), None)
    if label is None or label.pii:
        return "labels are not listed"
    rows = unmapped_labels(staged, res, column).collect()  # at most LABELS_LISTED rows
    return "; ".join(f"{r['value']}{f' @ {r.scope}' if r['scope'] else ''}: {r['rows']}" for r in rows)


# --- after the load ---------------------------------------------------------------------


def postload(rows: dict[str, DataFrame], res: Resolution, tables: dict[str, DataFrame], source_id: str, registered: int) -> list[Result]:
    """Source rows of each table (typed, with generated keys; of a dimension one row for each key)
    against the stored tables.  Each table is compared in one pass."""
    schema = res.schema
    phase = {"phase": "postload"}
    own = {name: df.where(F.col(SOURCE_ID) == source_id) for name, df in tables.items()}
    facts = [t for t in schema.facts if res.content(t)]
    dimensions = [t for t in schema.dimensions if res.has(t.columns[t.key])]
    links = [(t, d, k) for t, d, k in schema.relationships() if t in own and d in tables and k in own[t].columns]
    main = schema.tables[schema.main_fact]

    def linked(table: str, dimension: str, key: str) -> Result:
        n = orphans(own[table], tables[dimension], key).first()["orphans"]
        return Result("orphan_keys", f"{table}.{key}", n == 0, 0, n, **phase)

    def covered() -> Result:
        key = schema.spine_key
        row = coverage(rows[schema.spine_table].select(key), own[main.name], key).first()
        return Result("spine_coverage", main.name, True, row["spines"], row["covered"], f"{row['pct']}%", "postload", "info")

    jobs = [partial(_fact_parity, rows[t.name], res, t, own[t.name]) for t in facts]
    jobs += [partial(_dimension_parity, rows[t.name], res, t, tables[t.name], source_id) for t in dimensions]
    jobs += [partial(linked, *link) for link in links] + [covered] * bool(res.content(main))
    done = together(jobs)
    of_facts, rest = done[: len(facts)], done[len(facts) :]
    of_dimensions, rest = rest[: len(dimensions)], rest[len(dimensions) :]
    out = [r for first, _ in of_facts for r in first] + [first for first, _ in of_dimensions] + rest[: len(links)]
    out += [r for _, values in [*of_dimensions, *of_facts] for r in values]
    return [*out, Result("lineage", "dim_data_source", registered == 1, 1, registered, **phase), *rest[len(links) :]]


def _derived(t: Table, columns: list[str]) -> list[str]:
    return [c.name for c in t.columns.values() if c.expr and c.role != "key" and c.name in columns]


def _parity_results(t: Table, counts: dict[str, int]) -> list[Result]:
    """Mismatches of whole rows (``value_parity``) and of derived columns, as results."""
    return [Result("derived_parity" if c else "value_parity", f"{t.name}.{c}" if c else t.name, n == 0, 0, n, phase="postload") for c, n in counts.items()]


#: Bits of the lower part of a number of hundredths.
LOWER = 26


def _exact_sum(value, weight) -> list:
    """Three sums that give the sum of ``value`` (as a decimal with six places) times ``weight``.

    A number that is the nearest to a whole number of hundredths is summed as that number, in two
    parts that no count of rows makes overflow; only others are made decimals, which is slow."""
    number = value.cast("double")
    hundredths = F.rint(number * 100)
    short = (F.abs(number) < 1e13) & (hundredths / 100 == number)
    whole = F.when(short, hundredths).cast("bigint")
    return [
        F.sum(F.shiftright(whole, LOWER) * weight), F.sum(whole.bitwiseAND(F.lit((1 << LOWER) - 1)) * weight),
        F.sum(F.when(~short, value).cast("decimal(38,6)") * weight),
    ]


def _sum_of(parts: list) -> Decimal | None:
    upper, lower, rest = parts
    if upper is None and rest is None:
        return None
    return Decimal(((upper or 0) << LOWER) + (lower or 0)).scaleb(-2) + (rest or 0)


def _fact_parity(rows: DataFrame, res: Resolution, t: Table, own: DataFrame) -> tuple[list[Result], list[Result]]:
    """Row count, sums and every value of a fact, as multisets: each distinct row of the source
    should be stored once."""
    columns = [n for n, c in res.schema.physical(t).items() if res.has(c)]
    measures = [c.name for c in t.columns.values() if c.role == "measure" and res.has(c)]
    both = rows.select(*columns, F.lit(1).alias("_w"), F.lit(0).alias("_h")).unionByName(own.select(*columns, F.lit(0).alias("_w"), F.lit(1).alias("_h")))
    each = both.groupBy(*columns).agg(F.max("_w").alias("_w"), F.sum("_h").alias("_h"))
    sums = [s.alias(f"{w}{i}_{m}") for m in measures for w in ("_w", "_h") for i, s in enumerate(_exact_sum(F.col(m), F.col(w)))]
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    row = each.agg(total("_w", "_n_w"), total("_h", "_n_h"), total(F.abs(F.col("_w") - F.col("_h")), "_off"), *sums).first()
    out = [Result("fact_row_parity", t.name, row["_n_w"] == row["_n_h"], row["_n_w"], row["_n_h"], phase="postload")]
    for m in measures:
        want, have = (_sum_of([row[f"{w}{i}_{m}"] for i in range(3)]) for w in ("_w", "_h"))
        out.append(Result("measure_sum_parity", f"{t.name}.{m}", sums_match(want, have), want, have, phase="postload"))
    keys, counts = [g for g in (t.grain or [res.schema.spine_key]) if g in columns], {"": row["_off"]}
    for c in _derived(t, columns):
        some = list(dict.fromkeys([*keys, c]))
        counts[c] = difference_count(rows.select(*columns).distinct().select(*some), own.select(*some)).first()["mismatches"]
    return out, _parity_results(t, counts)


def _dimension_parity(rows: DataFrame, res: Resolution, t: Table, stored: DataFrame, source_id: str) -> tuple[Result, list[Result]]:
    """Whether every key of the source is stored, and with its values.

    A dimension row may hold values that another source brought first, so only rows that this
    source brought first are compared, and only where the source has a value.  Of a key with
    ``h`` such rows, ``e`` of them equal to the source's, ``abs(1 - e) + h - e`` rows differ."""
    columns = [n for n, c in res.schema.physical(t).items() if res.has(c) and n != t.key]
    checked = {"": columns} | {c: [c] for c in _derived(t, columns)}
    want = rows.select(t.key, *[F.col(c).alias(f"_w_{c}") for c in columns])
    have = stored.select(t.key, F.col(SOURCE_ID).eqNullSafe(F.lit(source_id)).alias("_own"), *columns)
    same = lambda c: F.col(f"_w_{c}").isNull() | F.col(f"_w_{c}").eqNullSafe(F.col(c))
    equal = [count_where(reduce(and_, map(same, own), F.col("_own"))).alias(f"_e{i}") for i, own in enumerate(checked.values())]
    each = want.join(have, t.key, "left").groupBy(t.key).agg(F.count("_own").alias("_found"), count_where(F.col("_own")).alias("_h"), *equal)
    off = [F.sum(F.when(F.col("_h") > 0, F.abs(1 - F.col(f"_e{i}")) + F.col("_h") - F.col(f"_e{i}"))) for i in range(len(checked))]
    row = each.agg(F.count(F.lit(1)).alias("_n"), count_where(F.col("_found") > 0).alias("_covered"), *[o.alias(f"_off{i}") for i, o in enumerate(off)]).first()
    covered = Result("entity_coverage", t.name, row["_n"] == row["_covered"], row["_n"], row["_covered"], phase="postload")
    return covered, _parity_results(t, {c: row[f"_off{i}"] or 0 for i, c in enumerate(checked)})
