"""Packing token sequences: shortest-pack-first over the length histogram.

Only the histogram of piece lengths reaches the driver (one number per length up
to the sequence size, whatever the corpus).  Lengths are placed longest first,
each time into the open packs with the most room; packs of one pattern are moved
together by count.  The resulting patterns are turned into slots, and each piece
finds its slot by its rank among the pieces of its length.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm._common import materialize, read_bytes, slices, tidied
from spindle.llm.bpe import LibraryBPE, loaded

RANKS = np.int64(1) << 44


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(count, [(length, repeats), ...])`` that hold exactly the histogram.

    ``histogram``: number of pieces of each length from 1 to ``size``."""
    done: list[tuple[int, list[tuple[int, int]]]] = []
    open_packs: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # (-room, order, count, pattern)
    order = 0
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"length {length} is not within 1..{size}")
        n = histogram[length]
        while n:
            if not open_packs or -open_packs[0][0] < length:
                room, count, pattern = size, n, []
                repeats = 1
            else:
                room, _, count, pattern = heapq.heappop(open_packs)
                room = -room
                # This pack stays the emptiest until it falls below the next one.
                below = -open_packs[0][0] if open_packs else 0
                repeats = max(1, min(room // length, -(-(room - below) // length), n // count))
            if n < count:
                heapq.heappush(open_packs, (-room, order, count - n, pattern))
                order += 1
                count = n
            n -= count * repeats
            if pattern and pattern[-1][0] == length:
                pattern = [*pattern[:-1], (length, pattern[-1][1] + repeats)]
            else:
                pattern = [*pattern, (length, repeats)]
            room -= length * repeats
            if room:
                heapq.heappush(open_packs, (-room, order, count, pattern))
                order += 1
            else:
                done.append((count, pattern))
    return done + [(count, pattern) for _, _, count, pattern in sorted(open_packs)]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Rank ranges of each length: where they lie in which sequences."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for count, pattern in patterns:
        fill, offset = sum(a * b for a, b in pattern), 0
        for length, repeats in pattern:
            first = used.get(length, 0)
            rows.append((length * int(RANKS) + first, base, offset, repeats, fill))
            used[length] = first + count * repeats
            offset += length * repeats
        base += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("key", "sequence", "offset", "repeats", "fill"), table.T.copy()))


def pieces(
    docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenises whole texts (null: empty), appends ``end_id``, and cuts each document
    into pieces of ``size`` ids and a rest; one row per piece."""
    raw = docs.sparkSession.sparkContext.broadcast(read_bytes(docs.sparkSession, tokenizer))
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        bpe = loaded(raw.value, LibraryBPE)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for first, texts in slices(batch, 1):
                for k, ids in enumerate(bpe.encode_batch(texts), first):
                    ids += end
                    n = len(ids) // 4
                    view = memoryview(ids)
                    for at in range(0, n, size):
                        own = view[4 * at : 4 * (at + size)]
                        rows.append((k, at, len(own) // 4, zlib.crc32(own), n))
            table = np.array(rows, dtype=np.int64).reshape(-1, 5)
            columns = [batch.column(0).take(pa.array(table[:, 0])), *(pa.array(table[:, i]) for i in range(1, 5))]
            yield pa.record_batch(columns, names=[id_col, "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(id_col, text_col).mapInArrow(tidied(run), schema)


def ranked(df: DataFrame, length: str, row: str) -> DataFrame:
    """Adds ``rank``, from 0 without gaps within each length; ``row`` is a number that no two
    rows share, in a written table.

    One length, and one repeated piece, may hold most rows, so ranks are counted within parts
    of a length, dealt by the row's number, and shifted by the rows in the parts before."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumn("part", F.pmod(F.xxhash64(row), F.lit(parts)))
    before = Window.partitionBy(length).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(length, "part").agg(F.count("*").alias("n"))
    shift = sizes.select(length, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = F.row_number().over(Window.partitionBy(length, "part").orderBy(row)) - 1
    return df.withColumn("own", own).join(shift, [length, "part"]).withColumn("rank", F.col("own") + F.col("shift"))


def pack(
    docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Packs all documents into sequences of at most ``size`` tokens.

    One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, sequence_tokens, padded_tokens``.  A null or empty text is the end id
    alone; repeated rows are packed once each; an empty table gives no rows.  Other columns,
    whatever their names, are not read.  Time is linear in a text's length.
    ``padded_tokens`` is ``size``, or the fill itself where that is a power of two.
    """
    cut = pieces(docs, tokenizer, size, end_id, id_col, text_col)
    cut = materialize(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    table = docs.sparkSession.sparkContext.broadcast(slots(pack_histogram(histogram, size)))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        s = table.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(s["key"], length * RANKS + rank, side="right") - 1
            past = rank - (s["key"][at] - length * RANKS)
            sequence = s["sequence"][at] + past // s["repeats"][at]
            offset = s["offset"][at] + past % s["repeats"][at] * length
            fill = s["fill"][at]
            padded = np.where(fill & (fill - 1), size, fill)
            columns = [batch.column(c) for c in names] + [pa.array(x) for x in (sequence, offset, fill, padded)]
            yield pa.record_batch(columns, names=[*names, "sequence_id", "offset", "sequence_tokens", "padded_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(
        f"{c} long" for c in (*names[1:], "sequence_id", "offset", "sequence_tokens", "padded_tokens")
    )
    return ranked(cut, "length", "row").select(*names, "rank").mapInArrow(tidied(place), schema)
