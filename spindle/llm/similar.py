"""Texts with similar shingles, all of them: prefix filtering.

Of two sets with a Jaccard similarity of at least t, each holds at least ``ceil(t * n)`` of
the other's members, ``n`` its own size.  In any order of all shingles, then, the first
``n - ceil(t * n) + 1`` shingles of the one and of the other have one in common, whatever
the shape of the edits.  These are the keys; every candidate that a signature of the sets does
not rule out is verified by the true overlap of the whole texts.

The order is by frequency, the rarest first, which keeps groups small and changes no result.
Frequencies are those of all texts, counted in a table of fixed size (``BUCKETS``).

Each task links the texts that share a key among its own rows to one of them, its hub, and
only hubs are shuffled, so that a key that very many texts share is a few rows of each task.
The hubs of a key are linked to one of them in turn.  A hub is the text in whose order the
key stands first: it has the fewest rare shingles of its own, so among edited copies of a text
it is the one that most others are closest to.  Members of a key that are
still in different components once these pairs are verified are compared pair by pair, and
a large component's members never among themselves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm._common import materialize, slices, small, tidied
from spindle.llm.components import components

BUCKETS, CHUNKS = 1 << 18, 64  # of the table of frequencies
CELLS = 256  # of a signature
MOST = 20_000  # rows of a key that one task compares, about
KEYS = 300_000  # keys that a task holds
PIECE = 1 << 18  # bytes of a text that are split into words at one time
BLANK = re.compile(rb"[\x20\x09-\x0d]")
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def word_pieces(text: str, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lowered, in lists of about ``piece`` bytes."""
    raw, at = text.encode("utf-8", "surrogatepass"), 0
    while at < len(raw):
        cut = BLANK.search(raw, at + piece) if at + piece < len(raw) else None
        end = cut.start() if cut else len(raw)
        yield raw[at:end].lower().split()
        at = end


def runs(h: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of ``words`` words, from the hashes of the words."""
    n = len(h) - words + 1
    out = np.zeros(n, np.uint64)
    for j in range(words):
        out = (out ^ out >> np.uint64(29)) * MIX[0] + h[j : j + n]
    out = (out ^ out >> np.uint64(32)) * MIX[1]
    return out ^ out >> np.uint64(29)


def shingles(text: str, words: int = 5, piece: int = PIECE) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles; none without words, and the whole
    text as one where it has fewer words than a shingle."""
    found, last = [], np.zeros(0, np.uint64)
    for part in word_pieces(text, piece):
        h = np.fromiter(map(xxhash.xxh64_intdigest, part), dtype=np.uint64, count=len(part))
        h = np.concatenate((last, h))
        if len(h) >= words:
            found.append(np.unique(runs(h, words)))
        last = h[-(words - 1) :] if words > 1 else h[:0]
    if not found:
        return runs(last, len(last)) if len(last) else last
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


def node(hashes: np.ndarray) -> int:
    """A 64-bit name of a set of shingles; texts with one set of shingles are one node."""
    value = xxhash.xxh64_intdigest(hashes.tobytes(), 7)
    return value - (1 << 64) if value >> 63 else value


# --- the order of shingles ----------------------------------------------------------------


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


class Frequencies:
    """How often shingles fall into each bucket, of one task."""

    def __init__(self):
        self.table = np.zeros(BUCKETS, np.int64)

    def add(self, sets: list[np.ndarray]) -> None:
        if sets:
            self.table += np.bincount(bucket(np.concatenate(sets)), minlength=BUCKETS)

    def chunks(self) -> list[bytes]:
        return [c.tobytes() for c in np.split(self.table, CHUNKS)]


def frequencies(rows: DataFrame) -> np.ndarray:
    """The sum of all tasks' tables ``rows(chunk, counts)``: ``BUCKETS`` numbers."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(raw.as_buffer(), np.int64)
                total[chunk] = total[chunk] + own if chunk in total else own
        if total:
            raw = pa.array([t.tobytes() for t in total.values()], pa.binary())
            yield pa.record_batch([pa.array(list(total), pa.int32()), raw], names=["chunk", "counts"])

    kind = "chunk int, counts binary"
    sums = rows.select("chunk", "counts").repartition(CHUNKS, "chunk").mapInArrow(tidied(run), kind)
    out = np.zeros((CHUNKS, BUCKETS // CHUNKS), np.int64)
    for r in sums.collect():  # one row per chunk
        out[r["chunk"]] += np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def prefix(hashes: np.ndarray, often: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set in the order: by their bucket's frequency, then by hash."""
    size = len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1
    return hashes[np.argsort(often[bucket(hashes)], kind="stable")[:size]]


def can_be_similar(n, pos, other_n, other_pos, similarity: float):
    """Whether sets of these sizes whose first common shingle stands at these places can have
    the similarity; of numbers, arrays or columns."""
    least, greatest = (F.least, F.greatest) if isinstance(n, Column) else (np.minimum, np.maximum)
    sizes = least(n, other_n) >= similarity * greatest(n, other_n) - 1e-6
    return sizes & (least(n - pos, other_n - other_pos) * (1 + similarity) >= similarity * (n + other_n) - 1e-6)


# --- keys ---------------------------------------------------------------------------------

KEYED = "key long, node long, n int, pos int, hub long, flag boolean"


def keyed(docs: DataFrame, often: np.ndarray, words: int, similarity: float, keys: int = KEYS) -> DataFrame:
    """The prefixes of ``docs(text)``: ``key, node, n (the set's size), pos (the key's place)``.

    Of the rows of a key that a task holds at one time, ``hub`` is null in the one with the
    key at the smallest place, and ``flag`` tells whether there are others; these have its node
    as ``hub``, and ``flag`` tells whether the two can be similar."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        order, held, sets, seen = shared.value, [], [], set()
        for batch in batches:
            for _, texts in slices(batch, 0):
                for t in texts:
                    own = shingles(t, words)
                    name = node(own)
                    if len(own) and name not in seen:
                        seen.add(name)
                        held.append(prefix(own, order, similarity))
                        sets.append((name, len(own), len(held[-1])))
                if sum(s[2] for s in sets) >= keys:
                    yield _hubs(held, sets, similarity)
                    held, sets, seen = [], [], set()
        if sets:
            yield _hubs(held, sets, similarity)

    return docs.select("text").mapInArrow(tidied(run), KEYED)


def _hubs(keys: list[np.ndarray], sets: list[tuple[int, int, int]], similarity: float) -> pa.RecordBatch:
    nodes, sizes, each = (np.array(c, dtype=np.int64) for c in zip(*sets))
    key = np.concatenate(keys).view(np.int64)
    own, n = np.repeat(nodes, each), np.repeat(sizes, each)
    pos = np.concatenate([np.arange(k) for k in each])
    by = np.lexsort((own, pos, key))
    key, own, n, pos = key[by], own[by], n[by], pos[by]
    first = np.concatenate(([True], key[1:] != key[:-1]))
    at = np.flatnonzero(first)[np.cumsum(first) - 1]  # of each row its hub's
    flag = can_be_similar(n, pos, n[at], pos[at], similarity)
    flag[first] = np.diff(np.append(np.flatnonzero(first), len(key))) > 1
    columns = [key, own, n.astype(np.int32), pos.astype(np.int32)]
    hub = pa.array(own[at], mask=first)
    return pa.record_batch([*map(pa.array, columns), hub, pa.array(flag)], names=["key", "node", "n", "pos", "hub", "flag"])


def shared_keys(own: DataFrame) -> DataFrame:
    """Of the hubs in :func:`keyed`, those whose key has another row, with the key's first
    hub ``a``, its ``an`` and ``apos``; one shuffle."""
    along = Window.partitionBy("key").orderBy("pos", "node")
    hubs = own.where("hub is null").select(
        "key", "node", "n", "pos", "flag", F.lag("node").over(along).alias("before"), F.lead("node").over(along).alias("after"),
        *(F.first(c).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(a) for c, a in (("node", "a"), ("n", "an"), ("pos", "apos"))),
    )
    # A node that several tasks had counts once.
    hubs = hubs.where("(before is null or before <> node) and (before is not null or after is not null or flag)")
    return hubs.select("key", "node", "n", "pos", "a", "an", "apos")


# --- verification -------------------------------------------------------------------------


def signature(hashes: np.ndarray) -> bytes:
    """The size of a set and, of each of ``CELLS`` parts of all hashes, how many it has, 255 for
    255 or more."""
    counts = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=CELLS)
    return len(hashes).to_bytes(8, "little") + np.minimum(counts, 255).astype(np.uint8).tobytes()


def promising(pairs: DataFrame, signs: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` that can be similar by their ``signs(node, sign)``: two sets share in
    no part more than the smaller has there, so no similar pair is left out."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, 8 + CELLS) for i in (2, 3)]
            n, m = (r[:, :8].copy().view("<i8")[:, 0] for r in rows)
            x, y = (r[:, 8:] for r in rows)
            both = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            full = ((x == 255) & (y == 255)).any(axis=1)
            keep = full | (both * (1 + similarity) >= similarity * (n + m) - 1e-6)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    need = small(materialize(nodes_of(pairs), "nodes"))
    own = signs.join(need, "node", "left_semi").groupBy("node").agg(F.first("sign").alias("sign"))
    own = materialize(own, "signs")
    one = lambda c: own.select(F.col("node").alias(c), F.col("sign").alias(f"{c}_sign"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "a_sign", "b_sign")
    return materialize(both.mapInArrow(tidied(run), "a long, b long"), "promising")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose ``sets(node, hashes)`` are similar enough."""

    def run(batches):
        for batch in batches:
            found = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                found.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    one = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"{c}_set"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "a_set", "b_set")
    return both.mapInArrow(tidied(run), "a long, b long")


def sets_of(docs: DataFrame, known: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """``node, hashes`` of all nodes in ``pairs``; ``known(id, node)`` tells their texts."""

    def run(batches):
        seen = set()
        for batch in batches:
            for _, texts in slices(batch, 0):
                own = {node(s): s.tobytes() for s in (shingles(t, words) for t in texts)}
                new = {k: v for k, v in own.items() if k not in seen}
                seen |= new.keys()
                yield pa.record_batch([pa.array(list(new), pa.int64()), pa.array(list(new.values()), pa.binary())], names=["node", "hashes"])

    ids = known.groupBy("node").agg(F.min("id").alias("id")).join(nodes_of(pairs), "node", "left_semi").select("id").distinct()
    found = docs.join(small(materialize(ids, "ids")), "id", "left_semi").select("text").mapInArrow(tidied(run), "node long, hashes binary")
    return materialize(found, "sets")  # a node that several tasks had gives a link twice


# --- members of a key in different components ---------------------------------------------


def cells(members: DataFrame, most: int) -> DataFrame:
    """``cell, node, n, pos, root`` of ``members(key, node, n, pos, root)``: any two members of
    a key with different roots meet in a cell, and no cell has more than about ``most`` rows.

    A key's largest component is cut into blocks, the others together into other blocks; each
    block of the ones meets each of the others, and these meet among themselves."""
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("key").agg(
        F.max_by("root", F.struct("size", "root")).alias("top"), F.max("size").alias("most"), F.sum("size").alias("all"), F.count("*").alias("roots"),
    )
    cut = lambda c: F.ceil(c * 2 / F.lit(most))
    mixed = mixed.where("roots > 1").select("key", "top", cut(F.col("most")).alias("tops"), cut(F.col("all") - F.col("most")).alias("rests"))
    rows = members.join(mixed, "key")
    top = F.col("root") == F.col("top")
    block = F.pmod(F.xxhash64("node"), F.when(top, F.col("tops")).otherwise(F.col("rests")))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    name = lambda kind, a, b: F.xxhash64("key", F.lit(kind), a, b)
    tops = F.transform(upto("rests"), lambda j: name(0, block, j))
    rests = F.concat(
        F.transform(upto("tops"), lambda i: name(0, i, block)), F.transform(upto("rests"), lambda j: name(1, F.least(block, j), F.greatest(block, j)))
    )
    return rows.select(F.explode(F.when(top, tops).otherwise(rests)).alias("cell"), "node", "n", "pos", "root")


def _crossing(similarity: float):
    """Partitions sorted by (cell, n): pairs of a cell in different components that can be
    similar."""

    def run(batches):
        found, size = [], 0
        for group in groups(batches):
            for pairs in crossing(group):
                found.append(pairs)
                size += len(pairs)
                if size > 100_000:
                    yield _pairs(found)
                    found, size = [], 0
        if found:
            yield _pairs(found)

    def groups(batches):
        held = np.zeros((0, 5), dtype=np.int64)  # cell, node, n, pos, root
        for batch in batches:
            rows = np.concatenate((held, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)))
            cut = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
            last = int(cut[-1]) if len(cut) else 0
            yield from np.split(rows[:last], cut[:-1]) if last else ()
            held = rows[last:]
        yield held

    def crossing(group):
        _, nodes, n, pos, root = group.T
        ends = np.searchsorted(n, (n + 1e-6) / similarity, "right")
        for i in range(len(group) - 1):
            j = slice(i + 1, int(ends[i]))
            near = (root[j] != root[i]) & can_be_similar(n[j], pos[j], n[i], pos[i], similarity)
            if near.any():
                other = nodes[j][near]
                yield np.stack([np.minimum(other, nodes[i]), np.maximum(other, nodes[i])], axis=1)

    return run


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.unique(np.concatenate(found), axis=0)
    return pa.record_batch([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"])


def similar_components(
    docs: DataFrame, known: DataFrame, often: np.ndarray, edges: DataFrame, words: int = 5, similarity: float = 0.8, most: int = MOST
) -> DataFrame:
    """``node, root`` of the nodes in links: those of ``edges(a, b)`` and all pairs of texts
    of ``docs(id, text)`` with at least this similarity.  ``known(id, node, sign)`` names each
    row's node and its signature, ``often`` has the frequencies of shingles."""
    own = materialize(keyed(docs, often, words, similarity), "keyed")
    shared = materialize(shared_keys(own), "shared")
    local = own.where("hub is not null")
    fits = can_be_similar(F.col("n"), F.col("pos"), F.col("an"), F.col("apos"), similarity)
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    stars = shared.where(F.col("node") != F.col("a")).where(fits).select(*pair("a", "node"))
    stars = materialize(stars.unionByName(local.where("flag").select(*pair("hub", "node"))).distinct(), "stars")
    near = promising(stars, known, similarity)
    links = materialize(verified(near, sets_of(docs, known, near, words), similarity), "links")
    edges = edges.unionByName(links)
    found = materialize(components(edges), "found")
    columns = ["key", "node", "n", "pos"]
    members = shared.select(*columns).unionByName(local.select(*columns)).join(small(found), "node", "left")
    members = materialize(members.select(*columns, F.coalesce("root", "node").alias("root")), "members")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells(members, most).repartition(parts, "cell").sortWithinPartitions("cell", "n")
    rest = dealt.mapInArrow(tidied(_crossing(similarity)), "a long, b long").distinct().join(stars, ["a", "b"], "left_anti")
    rest = materialize(rest, "rest")
    near = promising(rest, known, similarity)
    if near.isEmpty():
        return found
    more = materialize(verified(near, sets_of(docs, known, near, words), similarity), "links")
    return found if more.isEmpty() else components(edges.unionByName(more))
