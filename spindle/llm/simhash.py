"""SimHash near-duplicates with pigeonhole blocks.

A 64-bit fingerprint is cut into ``BLOCKS`` blocks.  Two fingerprints that differ
in at most ``distance`` bits agree on at least ``BLOCKS - distance`` whole blocks,
so they share one of the keys made of that many blocks.  Fingerprints are joined
on these keys, once each however many documents carry them, and every candidate
is verified by its Hamming distance.

Within one key only a spanning forest of the true links is returned, not all
pairs.  A key with more than ``most`` different fingerprints is passed on whole and
linked through midpoints instead (:func:`midpoint_links`), which is exact as well
and works row by row.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm._common import materialize, slices, small, tidied
from spindle.llm.components import components
from spindle.llm.similar import PIECE, Frequencies, frequencies, node, shingles, signature, similar_components, word_pieces

BLOCKS = 6
MOST = 20_000


def fingerprint(text: str, words: int = 3, seed: int = 42, piece: int = PIECE) -> int:
    """The fingerprint of one text as a signed 64-bit number; no words give 0.  A text is
    read in pieces, so memory does not follow its length."""
    total, n, last = np.zeros(64, dtype=np.int64), 0, []
    for part in word_pieces(text, piece):
        parts = [*last, *part]
        if len(parts) >= words:
            n += _add_bits(total, map(b" ".join, zip(*(parts[i:] for i in range(words)))), len(parts) - words + 1, seed)
        last = parts[-(words - 1) :] if words > 1 else []
    if not n and last:
        n = _add_bits(total, [b" ".join(last)], 1, seed)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def _add_bits(total: np.ndarray, shingles: Iterable[bytes], n: int, seed: int) -> int:
    h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype="<u8", count=n)
    for at in range(0, n, 1 << 15):
        bits = np.unpackbits(h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return n


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp`` of every whole text; a null text counts as empty."""

    def run(batches):
        for batch in batches:
            for at, texts in slices(batch, 1):
                fps = pa.array([fingerprint(t, words) for t in texts], pa.int64())
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), fps], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidied(run), f"`{id_col}` {kind}, fp long")


def block_masks(blocks: int, agree: int) -> list[int]:
    """Signed masks of all choices of ``agree`` of ``blocks`` blocks of a 64-bit word."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(each, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def hamming(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among different fingerprints."""
    rest, front, links = fps, np.zeros(0, dtype=np.int64), []
    while len(rest):
        if not len(front):
            front, rest = rest[:1], rest[1:]
        at, front = front[0], front[1:]
        near = hamming(rest, at) <= distance
        if near.any():
            found = rest[near]
            links.extend((int(at), int(x)) for x in found)
            front, rest = np.concatenate((front, found)), rest[~near]
    return links


def _linked(distance: int, most: int):
    """Partitions sorted by (mask, key): links as (a, b, null), and the members of
    keys with more than ``most`` fingerprints as (fp, null, mask)."""

    def run(batches):
        held, over = np.zeros((0, 3), dtype=np.int64), None  # the last key's rows; a key that is passed on
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            rows = np.concatenate((held, rows))
            out: list[tuple[int, int | None, int | None]] = []
            if over is not None:
                same = (rows[:, :2] == over).all(axis=1)
                out.extend((int(f), None, int(m)) for m, _, f in rows[same])
                rows = rows[~same]
                over = None if len(rows) else over
            if len(rows):
                new = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
                last = int(new[-1]) if len(new) else 0
                done, held = rows[:last], rows[last:]
                out.extend((a, b, None) for a, b in _groups(done, distance))
                if len(held) > most:
                    over = held[0, :2].copy()
                    out.extend((int(f), None, int(m)) for m, _, f in held)
                    held = held[:0]
            else:
                held = rows
            if out:
                yield _batch(out)
        if links := _groups(held, distance):
            yield _batch([(a, b, None) for a, b in links])

    return run


def _batch(rows) -> pa.RecordBatch:
    a, b, m = zip(*rows)
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(m, pa.int64())], names=["a", "b", "mask"])


def _groups(rows: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links within each run of equal (mask, key)."""
    if len(rows) < 2:
        return []
    cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
    begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(rows)]))
    size, fps, links = end - begin, rows[:, 2], []
    pair = begin[size == 2]
    near = pair[hamming(fps[pair], fps[pair + 1]) <= distance]
    links.extend(zip(fps[near].tolist(), fps[near + 1].tolist()))
    for a, b in zip(begin[size > 2].tolist(), end[size > 2].tolist()):
        links.extend(forest(fps[a:b], distance))
    return links


def midpoint_links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Links ``a, b`` that connect all of ``fps(fp)`` within ``distance`` bits.

    Fingerprints x and y within the distance have a point z between them, at most
    ``distance // 2`` bits from one and ``distance - distance // 2`` from the other.
    So around any z with a member in the inner ball, all members of the outer ball are
    connected through that member; each hooks to the smallest of them.  The rows grow in
    proportion to the fingerprints."""
    inner, outer = distance // 2, distance - distance // 2
    masks = [sum(1 << b for b in bits) for r in range(outer + 1) for bits in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    spark = fps.sparkSession
    table = spark.createDataFrame([(m, int(m.bit_count() if m >= 0 else (m + (1 << 64)).bit_count())) for m in signed], "flip long, bits int")
    ball = fps.select("fp").distinct().join(F.broadcast(table)).select("fp", F.expr("fp ^ flip").alias("z"), "bits")
    hub = ball.groupBy("z").agg(F.min("fp").alias("a"), F.min("bits").alias("bits"), F.count("*").alias("n"))
    hub = hub.where((F.col("n") > 1) & (F.col("bits") <= inner)).select("z", "a")
    return ball.join(hub, "z").where("fp <> a").select("a", F.col("fp").alias("b"))


def near_links(fps: DataFrame, distance: int = 3, blocks: int = BLOCKS, most: int = MOST) -> DataFrame:
    """Links ``a, b`` between different fingerprints of ``fps(fp)``: their components
    are those of all pairs within ``distance`` bits."""
    masks = block_masks(blocks, blocks - distance)
    one = F.array(*[F.struct(F.lit(i).cast("long").alias("mask"), F.expr(f"fp & {m}L").alias("key")) for i, m in enumerate(masks)])
    keyed = fps.select("fp").distinct().select(F.explode(one).alias("k"), "fp").select("k.mask", "k.key", "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "fp")
    found = materialize(dealt.mapInArrow(tidied(_linked(distance, most)), "a long, b long, mask long"), "links")
    links, large = found.where("mask is null").select("a", "b"), found.where("mask is not null")
    if not large.isEmpty():
        links = links.unionByName(midpoint_links(large.select(F.col("a").alias("fp")), distance))
    return links


def near_duplicates(
    docs: DataFrame, words: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, fp, component_id`` of every document.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; the
    component is named by its smallest id.  Empty and null texts have fingerprint 0 and
    are linked like others; repeated rows keep one result row each; an empty table gives
    none.  Texts are read in pieces, so memory does not follow their length."""
    own = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    least = own.groupBy("fp").agg(F.min(id_col).alias("least"))
    linked = least.join(components(near_links(own, distance)).withColumnRenamed("node", "fp"), "fp")
    # Names are written first, so that a join with one very large component can be split.
    named = materialize(linked.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    renamed = linked.join(named, "root").select("fp", "component_id")
    by_fp = least.join(renamed, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return own.join(by_fp, "fp").select(id_col, "fp", "component_id")


# --- one text of each group ---------------------------------------------------------------


def named(docs: DataFrame, words: int, similar_words: int, id_col: str, text_col: str) -> DataFrame:
    """``id, fp, node, sign`` of every whole text (texts with one set of shingles are one node
    and have one signature), and in rows with a ``chunk`` the tables of each task's frequencies
    of shingles."""
    names = ["id", "fp", "node", "sign", "chunk", "counts"]

    def run(batches):
        seen, kind = Frequencies(), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for at, texts in slices(batch, 1):
                sets = [shingles(t, similar_words) for t in texts]
                seen.add(sets)
                fps = pa.array([fingerprint(t, words) for t in texts], pa.int64())
                own = [pa.array(list(map(node, sets)), pa.int64()), pa.array(list(map(signature, sets)), pa.binary())]
                nothing = [pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.binary())]
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), fps, *own, *nothing], names=names)
        if kind is not None:
            counts = seen.chunks()
            nothing = [pa.nulls(len(counts), t) for t in (kind, pa.int64(), pa.int64(), pa.binary())]
            yield pa.record_batch([*nothing, pa.array(range(len(counts)), pa.int32()), pa.array(counts, pa.binary())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidied(run), f"id {kind}, fp long, node long, sign binary, chunk int, counts binary")


def deduplicated(
    docs: DataFrame, words: int = 3, distance: int = 3, similar_words: int = 5, similarity: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row of each group of near-duplicates, all columns unchanged: the row with the
    group's smallest id; of rows that repeat it, one stays.  Rows with a null id name no
    group and stay.  An empty table gives an empty one; texts are read in pieces, whatever
    their length.

    Groups are the components of all links between different texts: fingerprints within
    ``distance`` bits, and texts with ``similarity`` of shingles of ``similar_words`` words
    at least (:mod:`spindle.llm.similar`).  Ids are whole numbers."""
    found = materialize(named(docs, words, similar_words, id_col, text_col), "named")
    known = found.where("chunk is null and id is not null").select("id", "fp", "node", "sign")
    often = frequencies(found.where("chunk is not null"))
    by_fp = known.groupBy("fp").agg(F.min("node").alias("a"))
    same = known.select("fp", F.col("node").alias("b")).distinct().join(by_fp, "fp").select("a", "b")
    near = near_links(known, distance)
    near = near.join(by_fp.select(F.col("fp").alias("a"), F.col("a").alias("x")), "a").join(by_fp.select(F.col("fp").alias("b"), F.col("a").alias("y")), "b")
    edges = materialize(same.unionByName(near.select(F.col("x").alias("a"), F.col("y").alias("b"))).where("a <> b"), "edges")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    roots = similar_components(texts, known, often, edges, similar_words, similarity, MOST)
    least = known.groupBy("node").agg(F.min("id").alias("id")).join(roots, "node", "left")
    kept = materialize(least.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("id").alias("id")).select("id").distinct(), "kept")
    dropped = known.select("id").distinct().join(kept, "id", "left_anti").select(F.col("id").alias("_dropped"))
    dropped = small(materialize(dropped, "dropped"))
    left = docs.join(dropped, docs[id_col] == dropped["_dropped"], "left_anti")
    if not known.groupBy("id").count().where("count > 1").isEmpty():
        left = left.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(left.where(F.col(id_col).isNull()))
    return left
