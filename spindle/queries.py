"""One registered query per operator, each with the same question in ANSI SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions import masking
from spindle.functions.types import plain_label_column, plain_name_column, safe_cast, trimmed
from spindle.operators import checks, cube, keys, merge, pages, profile, resolve, slicer, synthetic, vocabulary
from spindle.operators.graph import JoinGraph
from spindle.plans import runs
from spindle.plans.spec import SOURCE_ROW, CrosswalkEntry, parse
from spindle.sources import staging
from spindle.sources.storage import shared_dir
from spindle.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}


def sales_graph() -> JoinGraph:
    graph = JoinGraph()
    graph.add("lineitem", "orders", "l_orderkey", "o_orderkey").add("orders", "customer", "o_custkey", "c_custkey")
    graph.add("customer", "nation", "c_nationkey", "n_nationkey").add("nation", "region", "n_regionkey", "r_regionkey")
    return graph.add("lineitem", "part", "l_partkey", "p_partkey").add("lineitem", "supplier", "l_suppkey", "s_suppkey")


def money(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,2))) as double)"


ORDER_OF_LINES = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINES_IN_ORDER = ", ".join(ORDER_OF_LINES)

# --- cubes and slices -------------------------------------------------------------------


@registered("""
SELECT r_name, c_mktsegment, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE l_returnflag = 'R' AND o_orderstatus IN ('O', 'F') GROUP BY r_name, c_mktsegment""")
def a1_slice_dice(spark, sf_dir):
    own = tables(spark, sf_dir, "lineitem", "orders", "customer", "nation", "region")
    wide = sales_graph().joined(own, "lineitem", "region")
    measures = {"n_lines": "count(1)", "gross": money("l_extendedprice")}
    return cube.slice_and_dice(wide, measures, ["r_name", "c_mktsegment"], {"l_returnflag": "R", "o_orderstatus": ["O", "F"]})


@registered("""
SELECT COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE o_orderstatus = 'F'""")
def a1_totals(spark, sf_dir):
    measures = {"n_orders": "count(1)", "total": money("o_totalprice")}
    return cube.slice_and_dice(table(spark, sf_dir, "orders"), measures, [], {"o_orderstatus": "F"})


@registered("""
SELECT r_name, n_name, COUNT(*) AS measure_val, CAST(GROUPING(r_name, n_name) AS BIGINT) AS grouping_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def a2_rollup(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "customer", "nation", "region"), "customer", "region")
    return cube.rollup(wide, ["r_name", "n_name"])


@registered("""
SELECT o_orderstatus, o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS measure_val,
CAST(GROUPING(o_orderstatus, o_orderpriority) AS BIGINT) AS grouping_id FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def a2_cube(spark, sf_dir):
    return cube.rollup(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], money("o_totalprice"), full=True)


@registered("""
SELECT o_orderpriority, COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) AS a_count, COUNT(CASE WHEN l_returnflag = 'N' THEN 1 END) AS n_count,
COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS r_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def a3_pivot(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "lineitem", "orders"), "lineitem", "orders")
    return cube.pivot(wide, "o_orderpriority", "l_returnflag")


@registered("""
SELECT c_mktsegment, COALESCE(CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS f_sum,
COALESCE(CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS o_sum
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def a3_pivot_measure(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "orders", "customer"), "orders", "customer")
    return cube.pivot(wide, "c_mktsegment", "o_orderstatus", money("o_totalprice"), ["F", "O"], "sum")


def _slices_sql(least: int) -> str:
    dims = {"o_orderstatus": 0, "o_orderpriority": 1, "c_mktsegment": 2}
    from itertools import combinations

    parts = []
    for depth in (1, 2, 3):
        for combo in combinations(dims, depth):
            names = ", ".join(combo)
            parts.append(
                f"SELECT '{','.join(combo)}' AS combination, {depth} AS depth, n FROM (SELECT {names}, COUNT(*) AS n FROM "
                f"orders JOIN customer ON o_custkey = c_custkey WHERE {' AND '.join(c + ' IS NOT NULL' for c in combo)} GROUP BY {names}) WHERE n >= {least}"
            )
    return (
        "SELECT combination, depth, COUNT(*) AS non_empty_cells, CAST(SUM(n) AS BIGINT) AS total_volume, MIN(n) AS min_cell_size, "
        f"MAX(n) AS max_cell_size, AVG(n) AS avg_cell_size FROM ({' UNION ALL '.join(parts)}) GROUP BY combination, depth"
    )


def _sliced(spark, sf_dir, least):
    wide = sales_graph().joined(tables(spark, sf_dir, "orders", "customer"), "orders", "customer")
    return slicer.deep_slices(wide, ["o_orderstatus", "o_orderpriority", "c_mktsegment"], 1, 3, least)


@registered(_slices_sql(1))
def a4_deep_slices(spark, sf_dir):
    return _sliced(spark, sf_dir, 1)


@registered(_slices_sql(20))
def a5_min_cell(spark, sf_dir):
    return _sliced(spark, sf_dir, 20)


@registered("""
SELECT o_orderstatus, c_mktsegment, COUNT(*) AS cell_count FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_orderstatus, c_mktsegment ORDER BY cell_count DESC, o_orderstatus, c_mktsegment LIMIT 5""")
def t2_slice_preview(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "orders", "customer"), "orders", "customer")
    return slicer.preview(wide, ["o_orderstatus", "c_mktsegment"], 5)


@registered("SELECT n_name, c_mktsegment, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment HAVING COUNT(*) >= 10")
def m17_k_anonymity(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "customer", "nation"), "customer", "nation")
    return profile.grouped_counts_k(wide, ["n_name", "c_mktsegment"], 10)


@registered("""
SELECT o_orderstatus, o_orderpriority, n, ROUND(CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY o_orderstatus), 8) AS share
FROM (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority)""")
def w3_share(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return cube.share_of_group(counts, ["o_orderstatus"], "n").withColumn("share", F.round("share", 8))


@registered("""
SELECT COUNT(*) AS rows, COUNT(o_totalprice) AS n, MIN(o_totalprice) AS low, MAX(o_totalprice) AS high,
ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice), 2) AS mean FROM orders""")
def a15_distribution(spark, sf_dir):
    return cube.distribution(table(spark, sf_dir, "orders"), "o_totalprice").withColumn("mean", F.round("mean", 2))


# --- joins ------------------------------------------------------------------------------


@registered("""
SELECT p_brand, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def j6_path_join(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "lineitem", "part"), "lineitem", "part")
    return cube.slice_and_dice(wide, {"n": "count(1)", "quantity": money("l_quantity")}, ["p_brand"])


@registered("""
SELECT c_mktsegment, n_name, COUNT(*) AS n_orders FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name""")
def j8_star(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "orders", "customer", "nation"), "orders", "nation", how="left")
    return cube.slice_and_dice(wide, {"n_orders": "count(1)"}, ["c_mktsegment", "n_name"])


@registered("""
SELECT COALESCE(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, COALESCE(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority,
a.n AS expected, b.n AS actual FROM (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY ALL) a
FULL OUTER JOIN (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderkey % 500 <> 0 AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') GROUP BY ALL) b
ON a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority WHERE a.n IS DISTINCT FROM b.n""")
def j10_compare_groups(spark, sf_dir):
    orders, by = table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"]
    some = orders.where("o_orderkey % 500 <> 0 and not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')")
    count = lambda df: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return cube.compare_groups(count(orders), count(some), by, "n")


@registered("""
SELECT CAST(SUM(total) AS DOUBLE) AS total FROM (SELECT DISTINCT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def j12_fanout_guard(spark, sf_dir):
    wide = sales_graph().joined(tables(spark, sf_dir, "lineitem", "orders"), "lineitem", "orders")
    wide = wide.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return cube.fan_out_safe_total(wide, ["o_orderkey"], "o_totalprice").select(F.col("total").cast("double").alias("total"))


@registered("""
SELECT * FROM (VALUES ('orders', 1, 'lineitem -> orders'), ('part', 1, 'lineitem -> part'), ('supplier', 1, 'lineitem -> supplier'),
('customer', 2, 'lineitem -> orders -> customer'), ('nation', 3, 'lineitem -> orders -> customer -> nation'),
('region', 4, 'lineitem -> orders -> customer -> nation -> region')) AS t(target, joins, path)""")
def m11_join_paths(spark, sf_dir):
    rows = [(r["target"], r["joins"], r["path"]) for r in sales_graph().paths_from("lineitem")]
    return spark.createDataFrame(rows, "target string, joins int, path string")


# --- projections and casts --------------------------------------------------------------

_RAW_ORDERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 101 = 0 THEN 'N/A' WHEN o_orderkey % 103 = 0 THEN '  '
ELSE '  ' || CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS VARCHAR) || ' ' END AS price,
CASE WHEN o_orderkey % 97 = 0 THEN 'UNKNOWN' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_orderkey AS k FROM orders"""


def raw_orders(spark, sf_dir) -> DataFrame:
    """Orders as a text export with faults put in."""
    k = F.col("o_orderkey")
    whole = F.floor("o_totalprice").cast("string")
    price = F.when(k % 101 == 0, "N/A").when(k % 103 == 0, "  ").otherwise(F.concat(F.lit("  "), whole, F.lit(" ")))
    day = F.when(k % 97 == 0, "UNKNOWN").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    status = F.when(k % 89 == 0, "X").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(k.cast("string").alias("id"), price.alias("price"), day.alias("day"), status.alias("status"), k.alias("k"))


@registered("""
SELECT k, TRY_CAST(id AS BIGINT) AS id, TRY_CAST(NULLIF(TRIM(price), '') AS BIGINT) AS price, TRY_CAST(day AS DATE) AS day, NULLIF(TRIM(status), '') AS status,
CAST(NULL AS DOUBLE) AS missing FROM (""" + _RAW_ORDERS + ")")
def p3_typed_projection(spark, sf_dir):
    raw = raw_orders(spark, sf_dir)
    return raw.select(
        "k", safe_cast(F.col("id"), "BIGINT").alias("id"), safe_cast(F.col("price"), "BIGINT").alias("price"),
        safe_cast(F.col("day"), "DATE").alias("day"), safe_cast(F.col("status"), "VARCHAR").alias("status"),
        F.lit(None).cast("double").alias("missing"),
    )


@registered("""SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') AS name,
lower(trim(regexp_replace('  ' || p_brand || '   ' || p_type || ' ', '\\s+', ' ', 'g'))) AS label FROM part""")
def p1_p8_normalisation(spark, sf_dir):
    both = F.concat_ws(" / ", "p_name", "p_type")
    label = F.concat(F.lit("  "), F.col("p_brand"), F.lit("   "), F.col("p_type"), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", plain_name_column(both).alias("name"), plain_label_column(label).alias("label"))


@registered("SELECT k, CAST(year(TRY_CAST(day AS DATE)) AS BIGINT) AS order_year, CASE WHEN NULLIF(TRIM(price), '') IS NOT NULL THEN id || ':' || TRIM(price) END AS made_key FROM (" + _RAW_ORDERS + ")")
def p5_p6_derived(spark, sf_dir):
    raw = raw_orders(spark, sf_dir)
    year = F.year(safe_cast(F.col("day"), "DATE")).cast("long")
    made = F.when(trimmed(F.col("price")).isNotNull(), F.concat_ws(":", "id", trimmed(F.col("price"))))
    return raw.select("k", year.alias("order_year"), made.alias("made_key"))


CROSSWALK = [
    CrosswalkEntry("Building", "construction"), CrosswalkEntry("machinery", "industry"), CrosswalkEntry("AUTOMOBILE", "transport"),
    CrosswalkEntry("building", "public works", "France"), CrosswalkEntry("household", "home", "GERMANY"),
]
_SEGMENTS = """SELECT c_custkey, n_name, CASE WHEN c_custkey % 3 = 0 THEN '  ' || lower(c_mktsegment) || ' ' ELSE c_mktsegment END AS label
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_MAPPED = """CASE WHEN l = 'building' AND s = 'france' THEN 'public works' WHEN l = 'household' AND s = 'germany' THEN 'home'
WHEN l = 'building' THEN 'construction' WHEN l = 'machinery' THEN 'industry' WHEN l = 'automobile' THEN 'transport' END"""


def segments(spark, sf_dir) -> DataFrame:
    wide = sales_graph().joined(tables(spark, sf_dir, "customer", "nation"), "customer", "nation")
    label = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))).otherwise(F.col("c_mktsegment"))
    return wide.select("c_custkey", "n_name", label.alias("label"))


@registered(f"SELECT c_custkey, {_MAPPED} AS category FROM (SELECT *, lower(trim(label)) AS l, lower(n_name) AS s FROM ({_SEGMENTS}))")
def p7_crosswalk(spark, sf_dir):
    return segments(spark, sf_dir).select("c_custkey", resolve.crosswalk_column(F.col("label"), CROSSWALK, F.col("n_name")).alias("category"))


@registered(f"SELECT c_custkey, {_MAPPED} AS category FROM (SELECT *, lower(trim(label)) AS l, lower(n_name) AS s FROM ({_SEGMENTS}))")
def p7_crosswalk_join(spark, sf_dir):
    return resolve.crosswalk_join(segments(spark, sf_dir), F.col("label"), CROSSWALK, "category", F.col("n_name")).select("c_custkey", "category")


@registered(f"""
SELECT trim(label) AS value, n_name AS scope, COUNT(*) AS rows FROM (SELECT *, lower(trim(label)) AS l, lower(n_name) AS s FROM ({_SEGMENTS}))
WHERE {_MAPPED} IS NULL GROUP BY ALL ORDER BY rows DESC, value, scope LIMIT 50""")
def t4_unmapped_labels(spark, sf_dir):
    df = segments(spark, sf_dir)
    mapped = resolve.crosswalk_column(F.col("label"), CROSSWALK, F.col("n_name"))
    rows = df.where(mapped.isNull()).groupBy(trimmed(F.col("label")).alias("value"), F.col("n_name").alias("scope")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.orderBy(F.desc("rows"), "value", "scope").limit(50)


@registered("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 7 <> 0 AND (l_quantity > 45 OR l_discount > 0.09)")
def p11_fact_filter(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber", "l_quantity",
        F.when(F.col("l_quantity") > 45, 1).alias("a"), F.when(F.col("l_discount") > 0.09, 1).alias("b"),
    )
    return df.where(F.col("l_orderkey").isNotNull() & (F.col("a").isNotNull() | F.col("b").isNotNull())).select("l_orderkey", "l_linenumber", "l_quantity")


# --- keys, dimensions, facts ------------------------------------------------------------


@registered(f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {LINES_IN_ORDER}) AS n FROM lineitem)
SELECT l_partkey, CAST(arg_min(l_suppkey, n) AS BIGINT) AS l_suppkey, arg_min(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, n) FILTER (WHERE l_returnflag <> 'N') AS returned
FROM r GROUP BY l_partkey""")
def a6_first_values(spark, sf_dir):
    # A total order needs no numbers here: the columns themselves are compared.
    rows = table(spark, sf_dir, "lineitem").withColumn(SOURCE_ROW, F.struct(*ORDER_OF_LINES))
    rows = rows.select("l_partkey", "l_suppkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("returned"), SOURCE_ROW)
    return merge.first_values(rows, "l_partkey")


@registered(f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {LINES_IN_ORDER}) AS _source_row FROM lineitem)
SELECT l_partkey, l_returnflag, l_linestatus, MIN(_source_row) AS _source_row FROM r GROUP BY l_partkey, l_returnflag, l_linestatus""")
def a7_fold_facts(spark, sf_dir):
    rows = keys.numbered(table(spark, sf_dir, "lineitem"), ORDER_OF_LINES, SOURCE_ROW)
    return merge.fold_facts(rows.select("l_partkey", "l_returnflag", "l_linestatus", SOURCE_ROW))


@registered(f"SELECT {LINES_IN_ORDER}, row_number() OVER (ORDER BY {LINES_IN_ORDER}) AS n FROM lineitem")
def w1_row_ordinal(spark, sf_dir):
    return keys.numbered(table(spark, sf_dir, "lineitem"), ORDER_OF_LINES).select(*ORDER_OF_LINES, F.col("n").cast("long").alias("n"))


@registered("""
SELECT 'dim_customer' AS dimension, CAST(o_custkey AS VARCHAR) AS natural_key,
'CUS-' || lpad(CAST(row_number() OVER (ORDER BY MIN(o_orderkey), CAST(o_custkey AS VARCHAR)) AS VARCHAR), 6, '0') AS surrogate_key, 'orders' AS source_id
FROM orders GROUP BY o_custkey""")
def m15_surrogates(spark, sf_dir):
    naturals = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("natural_key"), F.col("o_orderkey").alias("first_row"))
    return keys.new_keys(naturals, keys.empty_keymap(spark), "dim_customer", "orders")


_OLD_KEYS = """SELECT CAST(o_custkey AS VARCHAR) AS natural_key, row_number() OVER (ORDER BY MIN(o_orderkey), CAST(o_custkey AS VARCHAR)) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey"""


@registered(f"""
WITH old AS ({_OLD_KEYS}), fresh AS (SELECT CAST(o_custkey AS VARCHAR) AS natural_key, MIN(o_orderkey) AS f FROM orders
WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT natural_key FROM old) GROUP BY o_custkey)
SELECT 'dim_customer' AS dimension, natural_key, 'CUS-' || lpad(CAST((SELECT COUNT(*) FROM old) + row_number() OVER (ORDER BY f, natural_key) AS VARCHAR), 6, '0') AS surrogate_key, 'all' AS source_id FROM fresh""")
def m15_later_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("natural_key"), F.col("o_orderkey").alias("first_row"), "o_orderstatus")
    old = keys.new_keys(orders.where("o_orderstatus = 'F'"), keys.empty_keymap(spark), "dim_customer", "finished")
    return keys.new_keys(orders, old, "dim_customer", "all")


@registered(f"""
WITH old AS ({_OLD_KEYS}) SELECT o_orderkey, 'CUS-' || lpad(CAST(n AS VARCHAR), 6, '0') AS o_custkey FROM orders LEFT JOIN old ON CAST(o_custkey AS VARCHAR) = natural_key""")
def j1_key_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    done = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("natural_key"), F.col("o_orderkey").alias("first_row"))
    old = keys.new_keys(done, keys.empty_keymap(spark), "dim_customer", "finished")
    return keys.with_surrogate(orders.select("o_orderkey", "o_custkey"), old, "dim_customer", "o_custkey")


@registered("""
SELECT COALESCE(a.k, b.k) AS k, COALESCE(a.seg, b.seg) AS seg, a.bal AS bal, b.nat AS nat, CASE WHEN a.k IS NOT NULL THEN 'first' ELSE 'second' END AS _source_id
FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS seg, c_acctbal AS bal FROM customer WHERE c_custkey % 3 <> 0) a
FULL OUTER JOIN (SELECT c_custkey AS k, lower(c_mktsegment) AS seg, c_nationkey AS nat FROM customer WHERE c_custkey % 5 <> 0) b ON a.k = b.k""")
def s13_merge_dimension(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    old = c.where(k % 3 != 0).select(k.alias("k"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("seg"), F.col("c_acctbal").alias("bal"), F.lit("first").alias("_source_id"))
    new = c.where(k % 5 != 0).select(k.alias("k"), F.lower("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"), F.lit("second").alias("_source_id"))
    return merge.merge_dimension(old, new, "k")


@registered("""
SELECT (SELECT COUNT(*) FROM (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem EXCEPT ALL SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey % 50 = 0 THEN l_quantity + 1 ELSE l_quantity END FROM lineitem WHERE l_orderkey % 77 <> 0))
+ (SELECT COUNT(*) FROM (SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey % 50 = 0 THEN l_quantity + 1 ELSE l_quantity END FROM lineitem WHERE l_orderkey % 77 <> 0 EXCEPT ALL SELECT l_orderkey, l_partkey, l_quantity FROM lineitem)) AS mismatches""")
def c17_value_parity(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    k, q = F.col("l_orderkey"), F.col("l_quantity")
    b = a.where(k % 77 != 0).withColumn("l_quantity", F.when(k % 50 == 0, q + 1).otherwise(q))
    return merge.difference_count(a, b)


# --- checks -----------------------------------------------------------------------------


@registered("SELECT COUNT(*) FILTER (WHERE NULLIF(TRIM(id), '') IS NULL) AS spine_nulls FROM (SELECT CASE WHEN o_orderkey % 97 = 0 THEN ' ' ELSE CAST(o_orderkey AS VARCHAR) END AS id FROM orders)")
def c3_spine_nulls(spark, sf_dir):
    k = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select(F.when(k % 97 == 0, " ").otherwise(k.cast("string")).alias("id"))
    return df.agg(checks.count_where(trimmed(F.col("id")).isNull()).alias("spine_nulls"))


@registered("""
SELECT COUNT(CASE WHEN NULLIF(TRIM(price), '') IS NOT NULL AND TRY_CAST(NULLIF(TRIM(price), '') AS BIGINT) IS NULL THEN 1 END) AS price,
COUNT(CASE WHEN NULLIF(TRIM(day), '') IS NOT NULL AND TRY_CAST(day AS DATE) IS NULL THEN 1 END) AS day FROM (""" + _RAW_ORDERS + ")")
def c4_cast_failures(spark, sf_dir):
    fails = lambda c, kind: checks.count_where(trimmed(F.col(c)).isNotNull() & safe_cast(F.col(c), kind).isNull()).alias(c)
    return raw_orders(spark, sf_dir).agg(fails("price", "BIGINT"), fails("day", "DATE"))


@registered("SELECT COUNT(CASE WHEN NULLIF(TRIM(day), '') IS NOT NULL AND year(TRY_CAST(day AS DATE)) IS NULL THEN 1 END) AS underivable FROM (" + _RAW_ORDERS + ")")
def c5_derived_completeness(spark, sf_dir):
    year = F.year(safe_cast(F.col("day"), "DATE"))
    return raw_orders(spark, sf_dir).agg(checks.count_where(trimmed(F.col("day")).isNotNull() & year.isNull()).alias("underivable"))


@registered("""
SELECT COUNT(CASE WHEN status IS NOT NULL AND status NOT IN ('O', 'F', 'P') THEN 1 END) AS bad_status,
COUNT(CASE WHEN p < 1000 OR p > 400000 THEN 1 END) AS out_of_range, COUNT(CASE WHEN p IS NULL THEN 1 END) AS missing
FROM (SELECT status, TRY_CAST(NULLIF(TRIM(price), '') AS BIGINT) AS p FROM (""" + _RAW_ORDERS + "))")
def c6_c7_c8_values(spark, sf_dir):
    price = safe_cast(F.col("price"), "BIGINT")
    return raw_orders(spark, sf_dir).agg(
        checks.count_where(checks.outside_values(F.col("status"), ["O", "F", "P"])).alias("bad_status"),
        checks.count_where(checks.outside_range(price, 1000, 400000)).alias("out_of_range"),
        checks.count_where(price.isNull()).alias("missing"),
    )


@registered(f"SELECT COUNT(*) FILTER (WHERE trim(label) <> '' AND {_MAPPED} IS NULL) AS unmapped FROM (SELECT *, lower(trim(label)) AS l, lower(n_name) AS s FROM ({_SEGMENTS}))")
def c9_crosswalk_coverage(spark, sf_dir):
    mapped = resolve.crosswalk_column(F.col("label"), CROSSWALK, F.col("n_name"))
    return segments(spark, sf_dir).agg(checks.count_where(trimmed(F.col("label")).isNotNull() & mapped.isNull()).alias("unmapped"))


@registered("""
SELECT COUNT(*) FILTER (WHERE s > 1 OR p > 1) AS keys, COUNT(*) FILTER (WHERE s > 1) AS n_o_orderstatus, COUNT(*) FILTER (WHERE p > 1) AS n_o_orderpriority
FROM (SELECT o_custkey, COUNT(DISTINCT o_orderstatus) AS s, COUNT(DISTINCT o_orderpriority) AS p FROM orders GROUP BY o_custkey)""")
def c10_entity_consistency(spark, sf_dir):
    return checks.inconsistent_keys(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


@registered("SELECT COUNT(DISTINCT o_custkey) AS shared FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def c11_shared_keys(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct()
    return own.join(table(spark, sf_dir, "events").select(F.col("user_id").alias("k")), "k", "left_semi").agg(F.count(F.lit(1)).alias("shared"))


@registered("SELECT COUNT(*) AS groups FROM (SELECT l_orderkey, l_linenumber FROM (SELECT DISTINCT * FROM lineitem) GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)")
def c12_fact_grain(spark, sf_dir):
    return checks.repeated_grain(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered("""
SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem)) AS expected_rows, (SELECT COUNT(*) FROM lineitem WHERE l_orderkey % 91 <> 0) AS actual_rows,
(SELECT CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) FROM (SELECT DISTINCT * FROM lineitem)) AS expected_sum,
(SELECT CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem WHERE l_orderkey % 91 <> 0) AS actual_sum""")
def c13_c14_parity(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    total = lambda df, name: df.agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.expr(money("l_tax")).alias(f"{name}_sum"), F.lit(1).alias("one"))
    return total(lines.distinct(), "expected").join(total(lines.where("l_orderkey % 91 <> 0"), "actual"), "one").drop("one")


@registered("""
SELECT COUNT(*) AS orphans FROM (SELECT CASE WHEN l_orderkey % 60 = 0 THEN -l_orderkey ELSE l_orderkey END AS k FROM lineitem) l
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.k)""")
def c16_orphans(spark, sf_dir):
    k = F.col("l_orderkey")
    child = table(spark, sf_dir, "lineitem").select(F.when(k % 60 == 0, -k).otherwise(k).alias("k"))
    return checks.orphans(child, table(spark, sf_dir, "orders"), "k", "o_orderkey")


@registered("""
SELECT COUNT(*) AS want, COUNT(CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = k AND c_custkey % 40 <> 0) THEN 1 END) AS have
FROM (SELECT DISTINCT o_custkey AS k FROM orders)""")
def c15_entity_coverage(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct()
    dim = table(spark, sf_dir, "customer").where("c_custkey % 40 <> 0").select(F.col("c_custkey").alias("k"), F.lit(1).alias("h"))
    return own.join(dim, "k", "left").agg(F.count(F.lit(1)).alias("want"), F.count("h").alias("have"))


@registered("""
SELECT COUNT(*) AS spines, COUNT(l) AS covered, ROUND(COUNT(l) * 100.0 / COUNT(*), 2)::DOUBLE AS pct
FROM (SELECT DISTINCT o_orderkey FROM orders) LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON o_orderkey = l""")
def c20_spine_coverage(spark, sf_dir):
    out = checks.coverage(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
    return out.withColumn("pct", F.col("pct").cast("double"))


# --- profiles and text ------------------------------------------------------------------


def _stats_sql(name: str, columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        number, text, bounded = kind in ("BIGINT", "DOUBLE"), kind == "VARCHAR", kind == "BIGINT"
        parts.append(
            f"SELECT '{c}' AS variable, '{kind}' AS type, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 2)::DOUBLE AS null_pct, "
            f"COUNT(DISTINCT {c}) AS n_distinct, {f'CAST(MIN({c}) AS VARCHAR)' if bounded else 'NULL'} AS low, {f'CAST(MAX({c}) AS VARCHAR)' if bounded else 'NULL'} AS high, "
            f"{f'ROUND(AVG({c}), 4)' if number else 'CAST(NULL AS DOUBLE)'} AS mean, {f'CAST(MIN(LENGTH({c})) AS INTEGER)' if text else 'CAST(NULL AS INTEGER)'} AS min_length, "
            f"{f'CAST(MAX(LENGTH({c})) AS INTEGER)' if text else 'CAST(NULL AS INTEGER)'} AS max_length FROM {name}"
        )
    return " UNION ALL ".join(parts)


_PROFILED = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR", "o_orderpriority": "VARCHAR"}


@registered(_stats_sql("orders", _PROFILED))
def m1_profile(spark, sf_dir):
    return profile.column_stats(table(spark, sf_dir, "orders"), list(_PROFILED))


@registered("""
WITH c AS (SELECT 'p_size' AS variable, CAST(p_size AS VARCHAR) AS label, COUNT(*) AS n FROM part GROUP BY ALL
UNION ALL SELECT 'p_brand', p_brand, COUNT(*) FROM part GROUP BY ALL)
SELECT variable, CASE WHEN n >= 40 THEN label END AS label, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS labels FROM c WHERE label IS NOT NULL GROUP BY 1, 2""")
def a11_category_counts(spark, sf_dir):
    return profile.category_counts(table(spark, sf_dir, "part"), ["p_size", "p_brand"], 40)


@registered("""
SELECT event_type AS label, COUNT(*) AS rows, string_agg(DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR), ',' ORDER BY CAST(CAST(ts AS DATE) AS VARCHAR)) AS seen_at
FROM (SELECT event_type, ts FROM events UNION ALL SELECT event_type, ts FROM events WHERE value > 50) GROUP BY event_type""")
def m9_vocabulary(spark, sf_dir):
    own = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    out = vocabulary.label_counts([own, own.where("value > 50")], "event_type", "day")
    return out.withColumn("seen_at", F.array_join("seen_at", ","))


_RE2 = {k: p for k, _, p in masking.IDENTIFIERS}


@registered(f"""SELECT doc_id, regexp_replace(regexp_replace(text, '{_RE2["PHONE_NUMBER"]}', '<REDACTED_PHONE>', 'g'), '{_RE2["EMAIL_ADDRESS"]}', '<REDACTED_EMAIL>', 'g') AS text FROM documents""")
def m16_mask_contacts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", masking.mask_contacts(F.col("text"), ["PHONE_NUMBER", "EMAIL_ADDRESS"]).alias("text"))


@registered("SELECT c_custkey, 'Patient Name: <REDACTED_PATIENT_NAME> <REDACTED_MRN> <REDACTED_NIN> tel <REDACTED_PHONE> mail <REDACTED_EMAIL>.' AS note FROM customer")
def m16_mask_all(spark, sf_dir):
    c = F.col("c_custkey")
    note = F.concat(
        F.lit("Patient Name: Ann Mary Otim\nMRN-UG-"), (c % 1000000 + 1000000).cast("string"), F.lit(" NIN CM9501"), F.lpad((c % 10000).cast("string"), 4, "0"),
        F.lit("XYZ1 tel 0772 123 456 mail a"), c.cast("string"), F.lit("@b.org."),
    )
    masked = F.regexp_replace(masking.mask(note), "\n", " ")
    return table(spark, sf_dir, "customer").select("c_custkey", masked.alias("note"))


@registered("""
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Patient Name: <REDACTED_PATIENT_NAME>, Age: 5' WHEN 1 THEN '<REDACTED_PATIENT_NAME> saw ' || c_name
WHEN 2 THEN 'Clinician: Mulago Hospital ' || c_mktsegment WHEN 3 THEN 'Signed: <REDACTED_CLINICIAN>' WHEN 4 THEN 'Next of kin - <REDACTED_PATIENT_NAME> Ward: ' || c_mktsegment
ELSE 'Nurse Kampala, at the ' || lower(c_mktsegment) END AS note FROM customer""")
def m16_names(spark, sf_dir):
    k, segment = F.col("c_custkey") % 6, F.col("c_mktsegment")
    note = (
        F.when(k == 0, "Patient Name: Ann O'Tim, Age: 5").when(k == 1, F.concat(F.lit("Dr. Okello saw "), "c_name"))
        .when(k == 2, F.concat(F.lit("Clinician: Mulago Hospital "), segment)).when(k == 3, "Signed: K. Muwonge")
        .when(k == 4, F.concat(F.lit("Next of kin - Mary Ann Ward: "), segment)).otherwise(F.concat(F.lit("Nurse Kampala, at the "), F.lower(segment)))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", masking.mask_names(note, ["kampala"]).alias("note"))


def _entities_sql() -> str:
    """Every kind in the text that the kinds before it left."""
    text, parts = "coalesce(text, '')", []
    for kind, mask, pattern in masking.IDENTIFIERS:
        parts.append(f"SELECT doc_id, '{kind}' AS entity_type, u.m AS match FROM documents, unnest(regexp_extract_all({text}, '{pattern}')) AS u(m)")
        text = f"regexp_replace({text}, '{pattern}', '{mask}', 'g')"
    return " UNION ALL ".join(parts)


@registered(_entities_sql())
def m16_entities(spark, sf_dir):
    return masking.entities(table(spark, sf_dir, "documents"), "text", "doc_id")


@registered("""
SELECT doc_id, CAST(len(w) AS INTEGER) AS words, CAST(greatest(1, ceil(len(b) / 500.0)) AS INTEGER) AS pages, greatest(1, ceil(len(b) / 500.0)) > 3 AS "long"
FROM (SELECT doc_id, regexp_extract_all(text, '\\S+') AS w, regexp_extract_all(text, '[^ \\r\\n]+') AS b FROM documents)""")
def s7_pages(spark, sf_dir):
    out = pages.document_summary(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", "words", F.col("pages").cast("int").alias("pages"), "long")


_CONCEPTS = {"a": ["the", "one"], "b": ["ing", "license"], "c": ["que", "der"]}


@registered("""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^ \\r\\n]+') AS b FROM documents),
p AS (SELECT doc_id, CAST(i AS INTEGER) AS page, lower(array_to_string(b[(i - 1) * 500 + 1 : i * 500], ' ')) AS t FROM w, unnest(range(1, CAST(greatest(1, ceil(len(b) / 500.0)) AS BIGINT) + 1)) AS u(i)),
s AS (SELECT doc_id, page, c AS concept, CAST(CASE c WHEN 'a' THEN (length(t) - length(replace(t, 'the', ''))) // 3 + (length(t) - length(replace(t, 'one', ''))) // 3
WHEN 'b' THEN (length(t) - length(replace(t, 'ing', ''))) // 3 + (length(t) - length(replace(t, 'license', ''))) // 7
ELSE (length(t) - length(replace(t, 'que', ''))) // 3 + (length(t) - length(replace(t, 'der', ''))) // 3 END AS INTEGER) AS score FROM p, unnest(['a', 'b', 'c']) AS v(c))
SELECT doc_id, page, concept, score, CAST(row_number() OVER (PARTITION BY doc_id, concept ORDER BY score DESC, page) AS INTEGER) AS rank FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY doc_id, concept ORDER BY score DESC, page) <= 3""")
def s7_concept_pages(spark, sf_dir):
    return pages.concept_pages(table(spark, sf_dir, "documents"), "doc_id", "text", concepts=_CONCEPTS)


# --- a source with faults, before any load ---------------------------------------------------

_FAULTY = """(SELECT CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
CASE WHEN o_orderkey % 83 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_day, CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS status,
CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_suppkey AS supplier, CASE WHEN l_orderkey % 103 = 0 THEN 1000 WHEN l_orderkey % 101 <> 0 THEN l_quantity END AS quantity,
l_extendedprice AS price, l_returnflag AS returned, o_orderkey AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def faulty(spark, sf_dir):
    """Staged order lines with blank keys, texts for numbers and days, unknown codes, a value out
    of range and a column that no table takes; and how they feed the schema ``SALES``."""
    wide = sales_graph().joined(tables(spark, sf_dir, "lineitem", "orders", "customer"), "lineitem", "customer")
    k = F.col("l_orderkey")
    raw = wide.select(
        F.when(k % 97 == 0, "  ").otherwise(k.cast("string")).alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"), "c_mktsegment",
        F.col("c_acctbal").cast("string").alias("c_acctbal"), F.when(k % 83 == 0, "UNKNOWN").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_day"),
        F.when(k % 89 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "l_linenumber", "l_partkey", "l_suppkey",
        F.when(k % 103 == 0, "1000").when(k % 101 == 0, "N/A").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"), "l_extendedprice", "l_returnflag",
        F.lit("x").alias("surplus"),
    )
    staged = staging.stage_frame(raw)
    return staged, resolve.resolve(parse(SALES), staged.columns)


@registered(f"""
WITH n AS (SELECT COUNT(*) FILTER (WHERE order_id IS NULL) AS blank, COUNT(*) FILTER (WHERE order_day IS NULL) AS days, COUNT(*) FILTER (WHERE status = 'X') AS codes,
COUNT(*) FILTER (WHERE quantity IS NULL) AS texts, COUNT(*) FILTER (WHERE quantity > 100) AS far FROM {_FAULTY})
SELECT "check", target, CAST(value AS DOUBLE) AS actual, passed FROM (
SELECT 'variable_coverage' AS "check", 'source' AS target, 1 AS value, FALSE AS passed UNION ALL SELECT 'spine_key_present', 'dim_order.order_id', NULL, TRUE
UNION ALL SELECT 'spine_key_nulls', 'dim_order.order_id', blank, blank = 0 FROM n UNION ALL SELECT 'cast_failures', 'dim_customer.balance', 0, TRUE
UNION ALL SELECT 'cast_failures', 'dim_order.order_day', days, days = 0 FROM n UNION ALL SELECT 'required_nulls', 'dim_order.order_day', days, days = 0 FROM n
UNION ALL SELECT 'allowed_values', 'dim_order.status', codes, codes = 0 FROM n UNION ALL SELECT 'derived_completeness', 'dim_order.order_year', days, days = 0 FROM n
UNION ALL SELECT 'cast_failures', 'fact_lines.line', 0, TRUE UNION ALL SELECT 'cast_failures', 'fact_lines.part', 0, TRUE UNION ALL SELECT 'cast_failures', 'fact_lines.supplier', 0, TRUE
UNION ALL SELECT 'cast_failures', 'fact_lines.quantity', texts, texts = 0 FROM n UNION ALL SELECT 'value_range', 'fact_lines.quantity', far, far = 0 FROM n
UNION ALL SELECT 'cast_failures', 'fact_lines.price', 0, TRUE UNION ALL SELECT 'allowed_values', 'fact_lines.returned', 0, TRUE
UNION ALL SELECT 'entity_consistency', 'dim_customer', 0, TRUE UNION ALL SELECT 'entity_consistency', 'dim_order', 0, TRUE)""")
def c1_c12_preflight(spark, sf_dir):
    out = checks.as_frame(spark, checks.preflight(*faulty(spark, sf_dir)))
    return out.select("check", "target", F.col("actual").cast("double").alias("actual"), "passed")


@registered(f"""SELECT order_id, line, part, supplier, CAST(quantity AS DOUBLE) AS quantity, price, returned FROM {_FAULTY} WHERE order_id IS NOT NULL
AND COALESCE(CAST(line AS VARCHAR), CAST(part AS VARCHAR), CAST(supplier AS VARCHAR), CAST(quantity AS VARCHAR), CAST(price AS VARCHAR), returned) IS NOT NULL""")
def p11_fact_rows(spark, sf_dir):
    staged, res = faulty(spark, sf_dir)
    return resolve.fact_rows(staged, res, res.schema.tables["fact_lines"]).drop(SOURCE_ROW)


@registered(f"SELECT DISTINCT order_id, customer_id, order_day, status, CAST(year(order_day) AS BIGINT) AS order_year FROM {_FAULTY} WHERE order_id IS NOT NULL")
def p5_first_rows(spark, sf_dir):
    staged, res = faulty(spark, sf_dir)
    return merge.first_values(resolve.typed(staged, res, res.schema.tables["dim_order"]), "order_id")


# --- a loaded warehouse -------------------------------------------------------------------

#: The order lines as a constellation: orders are the spine.
SALES = {
    "schema_id": "sales", "spine": {"table": "dim_order", "key": "order_id"}, "main_fact": "fact_lines",
    "tables": {
        "dim_customer": {"kind": "dimension", "key": "customer_id", "columns": {
            "customer_id": {"type": "VARCHAR", "role": "key", "required": True, "aliases": ["o_custkey"]},
            "segment": {"type": "VARCHAR", "aliases": ["c_mktsegment"]}, "balance": {"type": "DOUBLE", "aliases": ["c_acctbal"]}}},
        "dim_order": {"kind": "dimension", "key": "order_id", "links": ["dim_customer"], "columns": {
            "order_id": {"type": "VARCHAR", "role": "key", "required": True, "aliases": ["o_orderkey"]},
            "order_day": {"type": "DATE", "required": True}, "status": {"type": "VARCHAR", "aliases": ["o_orderstatus"], "allowed": ["O", "F", "P"]},
            "order_year": {"type": "BIGINT", "expr": "year(try_cast(order_day as date))", "inputs": ["order_day"]}}},
        "fact_lines": {"kind": "fact", "columns": {
            "line": {"type": "BIGINT", "aliases": ["l_linenumber"]}, "part": {"type": "BIGINT", "aliases": ["l_partkey"]},
            "supplier": {"type": "BIGINT", "aliases": ["l_suppkey"]},
            "quantity": {"type": "DOUBLE", "role": "measure", "range": [0, 100], "aliases": ["l_quantity"]},
            "price": {"type": "DOUBLE", "role": "measure", "aliases": ["l_extendedprice"]},
            "returned": {"type": "VARCHAR", "allowed": ["A", "N", "R"], "aliases": ["l_returnflag"]}}},
    },
}
EXPORTED = ["o_orderkey", "o_custkey", "c_mktsegment", "c_acctbal", "order_day", "o_orderstatus", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
#: What each load brings: orders with even keys first, all others, then the first source again
#: without a fifth of its orders and with another quantity.
_PARTS = {"even": "o_orderkey % 2 = 0", "odd": "o_orderkey % 2 <> 0", "again": "o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0"}
_LOADED = """(SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS source_id, * FROM (SELECT DISTINCT o_orderkey, l_linenumber, l_partkey, l_suppkey,
CASE WHEN o_orderkey % 2 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_extendedprice, l_returnflag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 2 <> 0 OR o_orderkey % 5 <> 0))"""
_HOUSES: dict[tuple[str, str], Warehouse] = {}


def export(spark, sf_dir: str, which: str) -> str:
    """A raw CSV export of order lines; the folder's path."""
    own, graph = tables(spark, sf_dir, "lineitem", "orders", "customer"), sales_graph()
    wide = graph.joined({"lineitem": own["lineitem"], "orders": graph.joined(own, "orders", "customer")}, "lineitem", "orders")  # the lines move once
    wide = wide.withColumn("o_orderkey", F.col("l_orderkey")).withColumn("order_day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    if "o_custkey" not in wide.columns:
        wide = wide.withColumn("o_custkey", F.col("c_custkey"))
    if which == "again":
        wide = wide.withColumn("l_quantity", F.col("l_quantity") + 1)
    path = f"{shared_dir(spark)}/export-{which}-{uuid.uuid4().hex}"
    wide.where(_PARTS[which]).select(*EXPORTED).write.option("header", True).option("escape", '"').csv(path)
    return path


def loaded_sales(spark, sf_dir: str) -> Warehouse:
    """A warehouse after three loads of two sources, one for each session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _HOUSES:
        house = Warehouse(spark, f"{shared_dir(spark)}/house-{uuid.uuid4().hex}")
        for which, source in (("even", "even"), ("odd", "odd"), ("again", "even")):
            summary = house.load(parse(SALES), export(spark, sf_dir, which), source, multi_line=False)
            if not summary["ok"]:
                raise RuntimeError(f"load of {which}: {summary}")
        _HOUSES[at] = house
    return _HOUSES[at]


@registered(f"""SELECT source_id, COUNT(*) AS rows, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM {_LOADED} GROUP BY source_id""")
def s12_reloaded_facts(spark, sf_dir):
    sums = ", ".join(f"{money(c)} AS {c}" for c in ("quantity", "price"))
    return loaded_sales(spark, sf_dir).query(f"SELECT _source_id AS source_id, count(*) AS rows, {sums} FROM fact_lines GROUP BY _source_id")


@registered("""
SELECT c_mktsegment AS segment, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY c_mktsegment""")
def s13_loaded_dimension(spark, sf_dir):
    return loaded_sales(spark, sf_dir).query(f"SELECT segment, count(*) AS customers, {money('balance')} AS balance FROM dim_customer GROUP BY segment")


@registered(f"""
SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS BIGINT) AS order_year, COUNT(*) AS n FROM {_LOADED} f JOIN orders USING (o_orderkey) GROUP BY 1, 2""")
def s19_query(spark, sf_dir):
    sql = "SELECT status, order_year, count(*) AS n FROM fact_lines JOIN dim_order ON fact_lines.order_id = dim_order.order_id GROUP BY status, order_year"
    return loaded_sales(spark, sf_dir).query(sql)


@registered(f"""
SELECT 'fact_lines' AS table_name, COUNT(*) AS rows FROM {_LOADED} UNION ALL SELECT 'dim_data_source', 2
UNION ALL SELECT 'dim_order', COUNT(DISTINCT l_orderkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'dim_customer', COUNT(DISTINCT o_custkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def s20_table_counts(spark, sf_dir):
    return loaded_sales(spark, sf_dir).table_counts()


@registered("""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS source_id, 'sales' AS schema_id, FALSE AS is_synthetic, COUNT(*) AS row_count, CAST(12 AS BIGINT) AS column_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 2 <> 0 OR o_orderkey % 5 <> 0 GROUP BY 1""")
def s14_registry(spark, sf_dir):
    return loaded_sales(spark, sf_dir).read("dim_data_source").select("source_id", "schema_id", "is_synthetic", "row_count", "column_count")


@registered("""
SELECT segment, balance, _source_id FROM (SELECT c_mktsegment AS segment, c_acctbal AS balance, CASE WHEN c_custkey IN (SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderkey % 2 = 0) THEN 'even' ELSE 'odd' END AS _source_id, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
ORDER BY balance, segment LIMIT 20""")
def t5_first_rows(spark, sf_dir):
    return loaded_sales(spark, sf_dir).first_rows("dim_customer", 20, ["balance", "segment"]).select("segment", "balance", "_source_id")


@registered(f"""
WITH f AS (SELECT * FROM {_LOADED} WHERE source_id = 'odd'),
n(rows, quantity, price, orders, customers) AS (SELECT COUNT(*), SUM(CAST(l_quantity AS DECIMAL(18,2))), SUM(CAST(l_extendedprice AS DECIMAL(18,2))), COUNT(DISTINCT o_orderkey),
(SELECT COUNT(DISTINCT o_custkey) FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM f)) FROM f)
SELECT "check", target, CAST(value AS DOUBLE) AS expected, CAST(value AS DOUBLE) AS actual, TRUE AS passed FROM n, unnest([
{{'check': 'fact_row_parity', 'target': 'fact_lines', 'value': CAST(rows AS DECIMAL(20,2))}}, {{'check': 'measure_sum_parity', 'target': 'fact_lines.quantity', 'value': CAST(quantity AS DECIMAL(20,2))}},
{{'check': 'measure_sum_parity', 'target': 'fact_lines.price', 'value': CAST(price AS DECIMAL(20,2))}}, {{'check': 'entity_coverage', 'target': 'dim_order', 'value': CAST(orders AS DECIMAL(20,2))}},
{{'check': 'entity_coverage', 'target': 'dim_customer', 'value': CAST(customers AS DECIMAL(20,2))}}, {{'check': 'orphan_keys', 'target': 'dim_order.customer_id', 'value': CAST(0 AS DECIMAL(20,2))}},
{{'check': 'orphan_keys', 'target': 'fact_lines.order_id', 'value': CAST(0 AS DECIMAL(20,2))}}, {{'check': 'value_parity', 'target': 'fact_lines', 'value': CAST(0 AS DECIMAL(20,2))}},
{{'check': 'value_parity', 'target': 'dim_order', 'value': CAST(0 AS DECIMAL(20,2))}}, {{'check': 'value_parity', 'target': 'dim_customer', 'value': CAST(0 AS DECIMAL(20,2))}},
{{'check': 'derived_parity', 'target': 'dim_order.order_year', 'value': CAST(0 AS DECIMAL(20,2))}}, {{'check': 'lineage', 'target': 'dim_data_source', 'value': CAST(1 AS DECIMAL(20,2))}},
{{'check': 'spine_coverage', 'target': 'fact_lines', 'value': CAST(orders AS DECIMAL(20,2))}}]) AS u(c), LATERAL (SELECT c['check'] AS "check", c['target'] AS target, c['value'] AS value)""")
def c13_c20_postload(spark, sf_dir):
    summary = loaded_sales(spark, sf_dir).check(parse(SALES), "odd")
    rows = [checks.Result(**r) for r in summary["results"] if r["phase"] == "postload"]
    out = checks.as_frame(spark, rows)
    return out.select("check", "target", F.col("expected").cast("double").alias("expected"), F.col("actual").cast("double").alias("actual"), "passed")


@registered("SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def s19_sql(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")


@registered("""
SELECT * FROM (VALUES ('o_orderkey', 'VARCHAR', 'key', 'dim_order', TRUE), ('o_custkey', 'VARCHAR', 'key', 'dim_customer', TRUE), ('c_mktsegment', 'VARCHAR', 'attribute', 'dim_customer', FALSE),
('c_acctbal', 'DOUBLE', 'attribute', 'dim_customer', FALSE), ('order_day', 'DATE', 'attribute', 'dim_order', FALSE), ('o_orderstatus', 'VARCHAR', 'attribute', 'dim_order', FALSE),
('l_linenumber', 'BIGINT', 'attribute', 'fact_lines', FALSE), ('l_partkey', 'BIGINT', 'attribute', 'fact_lines', FALSE), ('l_suppkey', 'BIGINT', 'attribute', 'fact_lines', FALSE),
('l_quantity', 'DOUBLE', 'measure', 'fact_lines', FALSE), ('l_extendedprice', 'DOUBLE', 'measure', 'fact_lines', FALSE), ('l_returnflag', 'VARCHAR', 'attribute', 'fact_lines', FALSE))
AS t(variable, data_type, role, "table", is_key)""")
def m13_inventory(spark, sf_dir):
    rows = runs.FieldInventory(resolve.resolve(parse(SALES), EXPORTED)).rows()
    schema = "variable string, data_type string, role string, table string, is_key boolean"
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


@registered()
def m10_dummy(spark, sf_dir):
    return synthetic.generate(spark, parse(SALES), visits=200, seed=7)


@registered("""
SELECT 'status,returned' AS combination, 2 AS depth, COUNT(*) AS non_empty_cells, CAST(SUM(n) AS BIGINT) AS total_volume FROM (SELECT o_orderstatus, l_returnflag, COUNT(*) AS n FROM (""" + _LOADED + """) f JOIN orders USING (o_orderkey) GROUP BY 1, 2)""")
def m22_run(spark, sf_dir):
    house = loaded_sales(spark, sf_dir)
    out = runs.run_pipeline(house, parse(SALES), [], slice_dims=1, depth=(2, 2))
    wide = JoinGraph.of(parse(SALES)).joined({t: house.read(t).drop("_source_id", "_source_row") for t in ("fact_lines", "dim_order")}, "fact_lines", "dim_order")
    assert [p["target"] for p in out["paths"]] == ["dim_order", "dim_customer"]
    return slicer.deep_slices(wide, ["status", "returned"], 2, 2).select("combination", "depth", "non_empty_cells", "total_volume")


@registered("""
SELECT p_brand, r_name, COUNT(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size > 25 LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY p_brand, r_name""")
def j9_given_joins(spark, sf_dir):
    own = tables(spark, sf_dir, "lineitem", "part", "supplier", "nation", "region")
    joins = [
        cube.Join(own["part"], "l_partkey = p_partkey and p_size > 25"), cube.Join(own["supplier"], "l_suppkey = s_suppkey and s_acctbal > 0", "left"),
        cube.Join(own["nation"], "s_nationkey = n_nationkey", "left"), cube.Join(own["region"], "n_regionkey = r_regionkey", "left"),
    ]
    return cube.slice_and_dice(cube.with_joins(own["lineitem"], joins), {"n": "count(1)"}, ["p_brand", "r_name"])
