"""Exact top-k search by inner product, with norm-sorted pruning.

Vectors are cut into blocks by descending length.  Each query first meets the longest
vectors, which gives it a threshold: its k-th best score so far.  Blocks follow in rounds,
each as long as all rounds before it, and after each round the thresholds rise.  By
Cauchy-Schwarz a block whose longest vector is too short for the threshold holds no better
candidate, so a query goes on only to a prefix of the blocks.  Within a block, vectors are
rotated onto the principal axes of all vectors, and a candidate is scored in full only if its
partial sum over the leading axes plus the product of the residual lengths reaches the
threshold.  Scores are whole numbers and exact.

Queries are dealt to parts by the length they still need of a vector, so that the queries of
a part stop at about the same block, and a block is sent to a part only if one of its queries
goes there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm._common import materialize, tidied
from spindle.operators.keys import numbered

BLOCK, HEAD, QUERIES, LEAD = 16_384, 2_048, 2_048, 16
EXACT = float(1 << 52)
NOTHING = np.iinfo(np.int64).min  # the threshold of a query that has met fewer than k vectors


def quantized(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, v array<long>, norm`` of every usable vector: floor(scale * x) of each
    component.  Rows whose id or vector is null, whose vector is empty, or that hold a
    null or non-finite component take no part."""
    x = f"transform(`{vector_col}`, x -> cast(x as double))"
    df = vectors.select(F.col(id_col).alias("id"), F.expr(x).alias("x")).where("id is not null and x is not null and size(x) > 0")
    df = df.where("forall(x, y -> y is not null and not isnan(y) and abs(y) < double('infinity'))")
    df = df.select("id", F.expr(f"transform(x, y -> cast(floor({scale} * y) as bigint))").alias("v"))
    norm = "sqrt(aggregate(v, 0D, (a, y) -> a + cast(y as double) * cast(y as double)))"
    return df.withColumn("norm", F.expr(norm))


def _matrix(column: pa.Array | pd.Series, width: int | None = None) -> np.ndarray:
    """Rows as a matrix of whole numbers; shorter vectors are filled with zeros."""
    rows = column.to_pylist() if hasattr(column, "to_pylist") else [list(r) for r in column]
    width = width or max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point where no sum can lose a bit."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < EXACT:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


def axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Principal axes of all vectors, most important first (from the width x width
    matrix of second moments, summed per partition first)."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width).astype(np.float64)
            total += m.T @ m
        yield pa.record_batch([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = vectors.select("v").mapInArrow(tidied(run), "s array<double>").select(F.posexplode("s").alias("i", "s"))
    sums = {r["i"]: r["s"] for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect()}  # width ** 2 numbers
    moments = np.array([sums.get(i, 0.0) for i in range(width * width)]).reshape(width, width)
    moments /= max(np.abs(moments).max(), 1e-300)
    return np.linalg.svd(moments)[0]


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, -k)[-k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search_block(
    qid: np.ndarray, q: np.ndarray, floor: np.ndarray, cid: np.ndarray, c: np.ndarray, rotation: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """``(query, candidate, score)`` of each query's k best in a block that reach its
    threshold ``floor``; the query itself is no candidate."""
    qf, cf = q.astype(np.float64) @ rotation, c.astype(np.float64) @ rotation
    qn, cn = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    slack = 1e-9 * np.maximum(1.0, qn) * max(1.0, float(cn.max(initial=0)))
    lead = min(LEAD, q.shape[1])
    rest_q, rest_c = (np.linalg.norm(m[:, lead:], axis=1) for m in (qf, cf))
    out: list[tuple[int, int, int]] = []
    for a in range(0, len(q), 256):
        b = min(len(q), a + 256)
        bound = qf[a:b, :lead] @ cf[:, :lead].T + rest_q[a:b, None] * rest_c[None, :]
        open_ = bound >= (floor[a:b] - slack[a:b])[:, None]
        some = np.flatnonzero(open_.any(axis=0))
        if not len(some):
            continue
        scores = products(q[a:b], c[some])
        for i in range(b - a):
            keep = open_[i, some] & (scores[i] >= floor[a + i]) & (cid[some] != qid[a + i])
            at = some[keep]
            own = scores[i][keep]
            for j in best_of(own, cid[at], k):
                out.append((int(qid[a + i]), int(cid[at[j]]), int(own[j])))
    return out


OUT = "query_id long, vec_id long, score long"


def best(found: DataFrame, k: int, split: int) -> DataFrame:
    """The ``k`` best of each query in ``found(query_id, vec_id, score, block)``, with ``rank``.
    Rows of one query are first cut within ``split`` groups of blocks, so that no task gets all
    the candidates of a query that meets many blocks."""
    order = [F.desc("score"), F.col("vec_id")]
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    if split > 1:
        found = ranked(found.withColumn("group", F.pmod("block", F.lit(split))), "query_id", "group").drop("group", "rank")
    return ranked(found, "query_id").select("query_id", "vec_id", "score", "rank")


def in_blocks(df: DataFrame, name: str, size: int) -> DataFrame:
    """``df`` in order of ``down`` and ``id`` in blocks of ``size`` rows, numbered from 0; their
    number does not depend on that of the partitions."""
    return numbered(df, ["down", "id"], "n").withColumn(name, F.floor((F.col("n") - 1) / F.lit(size))).drop("n", "down")


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every query row (id divisible by ``every``)
    against all other rows.

    Vectors of different widths meet on their common components.  Rows of one id are
    one candidate each, and one query each of the same id is enough: of repeated query
    rows the first by its components is used; rows of the query's own id are no
    candidates.  An empty table gives no rows; other columns, whatever their names, are not
    read.  A block holds ``BLOCK`` vectors whatever their width."""
    spark = vectors.sparkSession
    own = materialize(quantized(vectors, scale, id_col, vector_col), "vectors")
    seen = own.agg(F.max(F.size("v")).alias("width"), F.count("*").alias("n")).first()
    if not seen["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = seen["width"]
    rotation = spark.sparkContext.broadcast(axes(own, width))
    by_length = own.orderBy(F.desc("norm"), "id", "v").limit(HEAD)
    head = by_length.collect()  # at most HEAD rows
    head_id = np.array([r["id"] for r in head])
    head_v = _matrix(pd.Series([r["v"] for r in head]), width)
    longest = spark.sparkContext.broadcast((head_id, head_v))

    first = Window.partitionBy("id").orderBy("v")
    queries = own.where(F.col("id") % every == 0).withColumn("copy", F.row_number().over(first)).where("copy = 1")

    def thresholds(batches):
        ids, block = longest.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q, qid = _matrix(batch.column("v"), width), batch.column("id").to_numpy()
            floor = np.full(len(q), NOTHING)
            for a in range(0, len(q), 256):
                scores = products(q[a : a + 256], block)
                for i, row in enumerate(scores):
                    others = row[ids != qid[a + i]]
                    if len(others) >= k:
                        floor[a + i] = np.partition(others, -k)[-k]
            yield pa.record_batch([*batch.columns, pa.array(floor)], names=[*batch.schema.names, "floor"])

    ready = queries.select("id", "v", "norm").mapInArrow(tidied(thresholds), "id long, v array<long>, norm double, floor long")
    need = F.col("floor") / F.greatest("norm", F.lit(1e-300))  # the length that a candidate must have
    waiting = materialize(in_blocks(materialize(ready, "queries").withColumn("down", -need), "part", QUERIES), "parts")

    # Blocks of candidates by descending length, and the longest vector of each.
    cut = materialize(in_blocks(own.withColumn("down", -F.col("norm")), "block", BLOCK), "blocks")
    limits = materialize(cut.groupBy("block").agg(F.max("norm").alias("most")), "limits")
    blocks = limits.agg(F.max("block").alias("b")).first()["b"] + 1
    reaches = F.expr("norm * most * (1 + 1e-9) + 1e-9 >= floor")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            rows = search_block(
                left["id"].to_numpy(), _matrix(left["v"], width), left["floor"].to_numpy(),
                right["id"].to_numpy(), _matrix(right["v"], width), rotation.value, k,
            )
        found = pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 3), columns=["query_id", "vec_id", "score"])
        return found.assign(block=right["block"].iloc[0] if len(right) else 0)

    done, begin = None, 0
    while begin < blocks:
        end = min(blocks, max(1, 2 * begin))
        here = limits.where(F.col("block").between(begin, end - 1))
        going = waiting.withColumn("block", F.explode(F.sequence(F.lit(begin).cast("long"), F.lit(end - 1).cast("long")))).join(here, "block").where(reaches)
        going = materialize(going.select("block", "part", "id", "v", "floor"), "going")
        pairs = going.select(F.col("block").alias("at"), F.col("part").alias("to")).distinct()
        meeting = cut.where(F.col("block").between(begin, end - 1)).join(pairs, F.col("block") == F.col("at")).select("block", F.col("to").alias("part"), "id", "v")
        found = going.groupBy("block", "part").cogroup(meeting.groupBy("block", "part")).applyInPandas(meet, OUT + ", block long")
        if done is not None:
            found = found.unionByName(done.select("query_id", "vec_id", "score", F.lit(-1).cast("long").alias("block")))
        done = materialize(best(found, k, int((end - begin) ** 0.5)), "best")
        if end < blocks:
            least = done.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
            risen = waiting.join(least, "id", "left").withColumn("floor", F.coalesce(F.greatest("floor", "least"), "floor"))
            shortest = here.agg(F.min("most")).first()[0]  # later blocks are no longer
            going_on = risen.where(F.lit(float(shortest)) * F.col("norm") * (1 + 1e-9) + 1e-9 >= F.col("floor"))
            waiting = materialize(going_on.select("id", "v", "norm", "floor", "part"), "parts")
            if waiting.isEmpty():
                break
        begin = end
    return done.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
