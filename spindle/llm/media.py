"""Media columns: byte payloads stored losslessly as FLAC, and read back."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spindle.llm import flac
from spindle.llm._common import slices, tidied

UNIT = 64


def payload(text: str) -> bytes:
    """UTF-8 with bytes 0 appended up to a positive multiple of ``UNIT``."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def features(raw: bytes) -> str:
    """Whole-number signal features of the samples: mean and mean square (each times
    1000, rounded down), zero crossings of the centred bytes, and the peak."""
    x = np.frombuffer(raw, dtype=np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"mean={int(x.sum()) * 1000 // len(x)};power={int((x * x).sum()) * 1000 // len(x)};crossings={crossings};peak={int(np.abs(x).max())}"


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, media``: every whole text as a FLAC stream (null: empty)."""

    def run(batches):
        for batch in batches:
            for at, own in slices(batch, 1, flac.GROUP):
                sizes = [len(t.encode("utf-8", "surrogatepass")) for t in own]
                media = flac.encode([payload(t) for t in own])
                columns = [batch.column(0).slice(at, len(own)), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())]
                yield pa.record_batch(columns, names=[id_col, "n_bytes", "media"])

    return docs.select(id_col, text_col).mapInArrow(tidied(run), f"`{id_col}` {_kind(docs, id_col)}, n_bytes long, media binary")


def pcm_blocks(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """``id_col, block, sample_offset, pcm``: the decoded blocks of every stream, each at
    its seekable sample offset.  Null media give no blocks; a stream that fails a
    checksum raises.  Streams of any encoder are read; a block is a frame."""

    def run(batches):
        for batch in batches:
            for i, stream in enumerate(batch.column(1)):
                if not stream.is_valid:
                    continue
                blocks = flac.decode_blocks([stream.as_py()])[0]
                columns = [
                    batch.column(0).take(pa.array([i] * len(blocks), pa.int64())),
                    pa.array(range(len(blocks)), pa.int64()),
                    pa.array([at for at, _ in blocks], pa.int64()),
                    pa.array([pcm for _, pcm in blocks], pa.binary()),
                ]
                yield pa.record_batch(columns, names=[id_col, "block", "sample_offset", "pcm"])

    schema = f"`{id_col}` {_kind(media, id_col)}, block long, sample_offset long, pcm binary"
    return media.select(id_col, media_col).mapInArrow(tidied(run), schema)


def stored_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every whole text as FLAC, decodes the stored bytes to PCM blocks with all
    checksums verified, and returns sizes, digests and features of what was read back, and
    how many blocks there are and at which sample the last one begins.

    A null or empty text is one unit of zeros; repeated rows give repeated results; an empty
    table gives none.  A text and its stream are in memory once each, and frames are
    processed about 2 MB at a time."""
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_blocks", "last_offset"]

    def run(batches):
        for batch in batches:
            for at, own in slices(batch, 1, flac.GROUP // 2):
                media = flac.encode([payload(t) for t in own])
                rows = []
                for t, stored, blocks in zip(own, media, flac.decode_blocks(media)):
                    raw = b"".join(pcm for _, pcm in blocks)
                    size = len(t.encode("utf-8", "surrogatepass"))
                    digest = hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-UNIT:])
                    whole = len(stored), hashlib.sha256(stored).hexdigest(), features(raw)
                    rows.append((size, len(raw), *digest, *whole, len(blocks), blocks[-1][0]))
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.record_batch([batch.column(0).slice(at, len(own)), *columns], names=names)

    schema = (
        f"`{id_col}` {_kind(docs, id_col)}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string, n_blocks long, last_offset long"
    )
    return docs.select(id_col, text_col).mapInArrow(tidied(run), schema)
