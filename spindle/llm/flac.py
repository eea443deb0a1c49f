"""A FLAC encoder and decoder for 8-bit mono samples, vectorised over frames; streams of
other encoders go to :mod:`spindle.llm.flac_stream`.

Streams follow the published format: STREAMINFO with the MD5 of the samples, a
SEEKTABLE with one point per frame, then frames with CRC-8 headers and CRC-16
footers whose subframe is constant, verbatim, or a linear predictor with Rice-coded
residuals in four partitions.

Encoding works on flat arrays over all frames of a group.  Decoding walks all frames
of a group side by side: step t reads the t-th code, or restores the t-th sample, of
every frame at once.  Frames are found through the seek table.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np

from spindle.llm import flac_stream
from spindle.llm.flac_stream import FlacError

BLOCK, ORDER, PRECISION, PARTS = 4096, 4, 12, 2  # samples, predictor, coefficient bits, log2 of partitions
RATE = 8000
CONSTANT, VERBATIM, LPC = 0x00, 0x02, 0x40 | (ORDER - 1) << 1
GROUP = 2_000_000


class Unusual(FlacError):
    """A well-formed stream of a form that is not read side by side."""


@lru_cache(maxsize=1)
def crc8_table() -> np.ndarray:
    c = np.arange(256, dtype=np.int64)
    for _ in range(8):
        c = np.where(c & 0x80, c << 1 ^ 0x107, c << 1)
    return c & 0xFF


@lru_cache(maxsize=1)
def crc16_table() -> np.ndarray:
    """Row d: what a byte adds to the checksum when d bytes follow it."""
    c = np.arange(256, dtype=np.int64) << 8
    for _ in range(8):
        c = np.where(c & 0x8000, c << 1 ^ 0x18005, c << 1)
    step = c & 0xFFFF
    rows = np.empty((BLOCK + 128, 256), dtype=np.uint16)
    rows[0] = row = step
    for d in range(1, len(rows)):
        row = (row << 8 & 0xFFFF) ^ step[row >> 8]
        rows[d] = row
    return rows


def crc16(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-16 of each range of ``data``; ranges are in order and not empty."""
    size = end - begin
    if len(size) and size.max() > BLOCK + 128:
        raise Unusual("a frame is too long")
    left = np.repeat(end, size) - np.arange(size.sum()) - np.repeat(begin - (np.cumsum(size) - size), size) - 1
    where = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return np.bitwise_xor.reduceat(crc16_table()[left, data[where]], np.cumsum(size) - size)


def _utf8_number(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers in the extended UTF-8 form: bytes in columns, and their number."""
    out, size = np.zeros((len(n), 6), dtype=np.int64), np.ones(len(n), dtype=np.int64)
    for k, top in enumerate((7, 11, 16, 21, 26, 31), 1):
        size[(n >> top) > 0] = k + 1
    if (size > 6).any():
        raise FlacError("too many frames")
    for k in range(6):
        rest = (size - 1 - k) * 6
        part = n >> np.maximum(rest, 0)
        lead = np.where(size == 1, n, 0xFF << (8 - size) & 0xFF | part)
        out[:, k] = np.where(k >= size, 0, lead if k == 0 else 0x80 | part & 0x3F)
    return out, size


def _lpc(x: np.ndarray, pos: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised predictors of all frames (Levinson-Durbin): (frames, ORDER) and shifts."""
    r = np.empty((len(heads), ORDER + 1))
    xf = x.astype(np.float64)
    for lag in range(ORDER + 1):
        product = xf[lag:] * xf[: len(xf) - lag]
        product[pos[lag:] < lag] = 0
        r[:, lag] = np.add.reduceat(np.concatenate((np.zeros(lag), product)), heads)
    a, error = np.zeros((len(heads), ORDER)), r[:, 0] * (1 + 1e-9) + 1e-9
    for i in range(ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(axis=1)) / error
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1].copy()
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    largest = np.maximum(np.abs(a).max(axis=1), 1e-9)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(largest) + 1e-9).astype(np.int64), 0, 15)
    limit = (1 << (PRECISION - 1)) - 1
    return np.clip(np.round(a * (2.0 ** shift)[:, None]), -limit, limit).astype(np.int64), shift


def encode_frames(samples: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Frames of signed samples (each frame's size a multiple of 64 up to BLOCK), with
    the given frame numbers; the bytes, and where each frame ends."""
    m, n = len(sizes), len(samples)
    heads = np.cumsum(sizes) - sizes
    frame = np.repeat(np.arange(m, dtype=np.int32), sizes)
    pos = np.arange(n, dtype=np.int32) - np.repeat(heads.astype(np.int32), sizes)
    x = samples.astype(np.int32)

    coef, shift = _lpc(x, pos, heads)
    pred = np.zeros(n, dtype=np.int32)
    for j in range(ORDER):
        pred[j + 1 :] += np.repeat(coef[:, j].astype(np.int32), sizes)[j + 1 :] * x[: n - j - 1]
    pred >>= np.repeat(shift.astype(np.int32), sizes)
    u = x - pred
    u = u << 1 ^ u >> 31
    warm = pos < ORDER
    u[warm] = 0
    quarters = np.repeat(sizes >> PARTS, 1 << PARTS)
    part_heads = np.cumsum(quarters) - quarters
    total = np.add.reduceat(u, part_heads, dtype=np.int64)
    count = quarters.copy()
    count[:: 1 << PARTS] -= ORDER
    k = np.clip(np.ceil(np.log2(np.maximum(total / count, 1))).astype(np.int32) - 1, 0, 14)
    kf = np.repeat(k, quarters)
    bits = (u >> kf) + (kf + 1)
    bits[warm] = 0
    cost = np.add.reduceat(bits, heads, dtype=np.int64) + (4 << PARTS) + 15 + (8 + PRECISION) * ORDER

    # The cheapest subframe of each frame.
    kind = np.where(cost < 8 * sizes, LPC, VERBATIM)
    kind[np.minimum.reduceat(x, heads) == np.maximum.reduceat(x, heads)] = CONSTANT
    lpc = kind == LPC
    order = np.where(lpc, ORDER, 0)
    value = u & ((1 << kf) - 1) | (1 << kf)
    value[warm] = 0
    if not lpc.all():
        other = ~np.repeat(lpc, sizes)
        plain = np.repeat(kind == VERBATIM, sizes)
        bits[other], value[other] = 0, 0
        bits[plain], value[plain] = 8, x[plain] & 0xFF

    # Fields before the samples, one row per frame: (value, bits) in columns.
    number, length = _utf8_number(numbers)
    small = np.where(sizes == BLOCK, 0, np.where(sizes <= 256, 8, 16))
    code = np.where(small == 0, 0xC, np.where(small == 8, 6, 7))
    fields = [(np.full(m, 0xFF), 8), (np.full(m, 0xF8), 8), (code << 4 | 4, 8), (np.full(m, 0x02), 8)]
    fields += [(number[:, j], np.where(j < length, 8, 0)) for j in range(6)]
    fields += [((sizes - 1) >> 8, np.where(small == 16, 8, 0)), ((sizes - 1) & 0xFF, np.where(small > 0, 8, 0))]
    crc = np.zeros(m, dtype=np.int64)
    for v, b in fields:
        crc = np.where(np.broadcast_to(b, m) > 0, crc8_table()[crc ^ v], crc)
    fields += [(crc, 8), (kind, 8)]
    for j in range(ORDER):
        first = x[np.minimum(heads + j, n - 1)] & 0xFF
        fields.append((first, np.where((j < order) | ((kind == CONSTANT) & (j == 0)), 8, 0)))
    fields += [(np.full(m, PRECISION - 1), np.where(lpc, 4, 0)), (shift, np.where(lpc, 5, 0))]
    fields += [(coef[:, j] & ((1 << PRECISION) - 1), np.where(lpc, PRECISION, 0)) for j in range(ORDER)]
    fields += [(np.full(m, PARTS), np.where(lpc, 6, 0))]
    before_v = np.stack([np.broadcast_to(v, m) for v, _ in fields], axis=1)
    before_b = np.stack([np.broadcast_to(b, m) for _, b in fields], axis=1)
    before_v = np.where(before_b > 0, before_v, 0)

    lead = before_b.sum(axis=1)
    run = np.cumsum(bits, dtype=np.int64)
    own_bits = np.diff(run[heads + sizes - 1], prepend=0)
    total_bits = lead + own_bits + (np.where(lpc, 4, 0) << PARTS)
    frame_bytes = (total_bits + 7) // 8 + 2
    ends = np.cumsum(frame_bytes)
    base = (ends - frame_bytes) * 8
    parts = np.arange(1, (1 << PARTS) + 1)
    moved_by = (base + lead - (np.cumsum(own_bits) - own_bits))[:, None] + np.where(lpc, 4, 0)[:, None] * parts
    sample_end = run + np.repeat(moved_by.ravel(), quarters)
    part_start = sample_end[part_heads] - bits[part_heads]
    out = np.zeros(int(ends[-1]) + 4, dtype=np.float64)

    def put(end: np.ndarray, v: np.ndarray) -> None:
        """Values of at most 17 significant bits that end at the given bits."""
        byte, moved = (end - 1) >> 3, v << (7 - (end - 1 & 7))
        for back in range(3):
            own = moved >> 8 * back & 0xFF
            out[: len(out) - back] += np.bincount(byte, own, len(out))[back:]

    put(np.maximum(sample_end, 1), value)
    put((base[:, None] + np.cumsum(before_b, axis=1))[before_b > 0], before_v[before_b > 0])
    put(part_start[np.repeat(lpc, 1 << PARTS)], k[np.repeat(lpc, 1 << PARTS)])
    data = out.astype(np.uint8)
    footer = crc16(data, ends - frame_bytes, ends - 2).astype(np.int64)
    data[ends - 2], data[ends - 1] = footer >> 8, footer & 0xFF
    return data[: ends[-1]].tobytes(), ends


def _windows(data: bytes) -> np.ndarray:
    """64 bits from each byte on."""
    raw = np.frombuffer(data + bytes(16), dtype=np.uint8)
    words = np.zeros(len(raw) - 8, dtype=np.uint64)
    for j in range(8):
        words |= raw[j : len(raw) - 8 + j].astype(np.uint64) << np.uint64(56 - 8 * j)
    return words


def decode_frames(data: bytes, begin: np.ndarray, end: np.ndarray, numbers: np.ndarray) -> list[np.ndarray]:
    """Samples (int8) of the frames at the given byte ranges; checks both checksums."""
    raw, w, m = np.frombuffer(data, dtype=np.uint8), _windows(data), len(begin)
    if crc16(raw, begin, end).any():
        raise FlacError("a frame's checksum differs")
    at = begin * 8

    def take(bits, where=None) -> np.ndarray:
        """The next bits (a number, or one each) of all frames."""
        nonlocal at
        n = np.broadcast_to(np.asarray(bits, dtype=np.int64), m)
        got = (w[at >> 3] << (at & 7).astype(np.uint64)) >> np.uint64(40)
        at = at + n
        return (got.astype(np.int64) >> np.maximum(24 - n, 0)) & ((1 << n) - 1)

    if (take(16) != 0xFFF8).any():
        raise FlacError("no frame where the seek table says")
    code, rest = take(8), take(8)
    if (rest != 0x02).any() or ((code & 0xF) != 4).any():
        raise Unusual("no 8-bit mono frames at 8 kHz")
    code >>= 4
    lead = take(8)
    more = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC], [0, 1, 2, 3, 4], 5)
    number = np.where(more == 0, lead, lead & (0x3F >> more))
    for j in range(5):
        number = np.where(j < more, number << 6 | take(np.where(j < more, 8, 0)) & 0x3F, number)
    extra = take(np.where(code == 6, 8, np.where(code == 7, 16, 0)))
    size = np.where(code == 0xC, BLOCK, extra + 1)
    head = (at >> 3) - begin
    crc = np.zeros(m, dtype=np.int64)
    for j in range(int(head.max(initial=0))):
        crc = np.where(j < head, crc8_table()[crc ^ raw[np.minimum(begin + j, len(raw) - 1)]], crc)
    if (take(8) != crc).any() or (number != numbers).any():
        raise FlacError("a frame header's checksum or number differs")
    kind = take(8)
    lpc, plain, constant = kind == LPC, kind == VERBATIM, kind == CONSTANT
    if not (lpc | plain | constant).all():
        raise Unusual("another subframe")
    order = np.where(lpc, ORDER, 0)
    signed = lambda v, b: v - ((v >> (b - 1) & 1) << b)
    warm = np.stack([signed(take(np.where((j < order) | (constant & (j == 0)), 8, 0)), 8) for j in range(ORDER)])
    if (lpc & (take(np.where(lpc, 4, 0)) != PRECISION - 1)).any():
        raise Unusual("another precision")
    shift = take(np.where(lpc, 5, 0))
    coef = np.stack([signed(take(np.where(lpc, PRECISION, 0)), PRECISION) for _ in range(ORDER)])
    coef[0] = np.where(constant, 1, coef[0])
    order = np.where(constant, 1, order)
    if (take(np.where(lpc, 6, 0))[lpc] != PARTS).any():
        raise Unusual("another residual coding")

    # Longest frames first, so that the frames still running are a prefix.
    by = np.argsort(-size, kind="stable")
    size, at, order, shift, warm, coef = size[by], at[by], order[by], shift[by], warm[:, by], coef[:, by]
    rice, plain = lpc[by], plain[by]
    width = int(size.max(initial=0))
    x = np.zeros((width + ORDER, m), dtype=np.int32)  # the residuals, then the samples in their place
    live = m - np.searchsorted(size[::-1], np.arange(width), side="right")  # frames longer than t
    if rice.any():
        _read_rice(w, at, size, rice, x[ORDER:])
    for i in np.flatnonzero(plain):
        own = (w[(at[i] >> 3) + np.arange(size[i])] << np.uint64(at[i] & 7)) >> np.uint64(56)
        x[ORDER : ORDER + size[i], i] = own.astype(np.uint8).view(np.int8)
    turned, shift = coef[::-1].astype(np.int32), shift.astype(np.int32)
    for t in range(width):
        a = live[t]
        pred = np.einsum("ja,ja->a", turned[:, :a], x[t : t + ORDER, :a])
        pred >>= shift[:a]
        if t < ORDER:
            pred = np.where(t < order[:a], warm[t, :a], pred)
        x[t + ORDER, :a] += pred
    samples = x[ORDER:].T.astype(np.int8)
    back = np.empty(m, dtype=np.int64)
    back[by] = np.arange(m)
    return [samples[i, : size[i]] for i in back]


def _read_rice(w, at, size, rice, residual) -> None:
    """Reads the codes of all Rice frames side by side into ``residual[t, frame]``."""
    here = np.flatnonzero(rice)
    at, part, eight = at[here].copy(), size[here] >> PARTS, np.uint64(32)
    for p in range(1 << PARTS):
        k = ((w[at >> 3] << (at & 7).astype(np.uint64)) >> np.uint64(60)).astype(np.int64)
        if (k == 15).any():
            raise Unusual("an escaped partition")
        at += 4
        first = 0 if p else ORDER
        longest = int(part.max())
        begin, ones = np.zeros((2, longest, len(here)), np.int64)
        lives = (len(part) - np.searchsorted(part[::-1], np.arange(longest), side="right")).tolist()
        past = k + 33
        for t in range(first, longest):
            a = lives[t]
            pos = at[:a]
            begin[t, :a] = pos
            top = w[pos >> 3]
            top <<= (pos & 7).view(np.uint64)
            top >>= eight
            length = np.frexp(top.astype(np.float64))[1]
            if not length.all():
                length = _long_run(w, pos, length)
            ones[t, :a] = length
            at[:a] += past[:a] - length
        inside = np.arange(longest)[:, None] < part
        if first:
            inside[:first] = False
        rows, columns = np.nonzero(inside)
        high, kk = 32 - ones[rows, columns], k[columns]
        after = begin[rows, columns] + high + 1
        low = ((w[after >> 3] << (after & 7).view(np.uint64)) >> np.uint64(49)).view(np.int64) >> (15 - kk)
        u = high << kk | low
        residual[rows + p * part[columns], here[columns]] = u >> 1 ^ -(u & 1)


def _long_run(w, pos, length):
    """32 less the zeros before the next one bit, for runs beyond one window."""
    length, far = length.astype(np.int64), pos.copy()
    zero = length == 0
    while zero.any():
        far += np.where(zero, 32, 0)
        if (far >> 3).max() >= len(w):
            raise FlacError("a code runs past the end")
        top = (w[far >> 3] << (far & 7).astype(np.uint64)) >> np.uint64(32)
        own = np.frexp(top.astype(np.float64))[1].astype(np.int64)
        length, zero = np.where(zero, own - (far - pos), length), zero & (own == 0)
    return length


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream of each payload, whose length is a positive multiple of 64."""
    work = [(i, at) for i, p in enumerate(payloads) for at in range(0, len(p), BLOCK)]
    parts: list[list[bytes]] = [[] for _ in payloads]
    for group in _grouped(work, lambda w: min(BLOCK, len(payloads[w[0]]) - w[1])):
        cut = [payloads[i][at : at + BLOCK] for i, at in group]
        sizes = np.array([len(c) for c in cut])
        samples = np.frombuffer(b"".join(cut), dtype=np.uint8).astype(np.int16) - 128
        data, ends = encode_frames(samples, sizes, np.array([at // BLOCK for _, at in group]))
        begin = 0
        for (i, _), end in zip(group, ends.tolist()):
            parts[i].append(data[begin:end])
            begin = end
    return [_stream(p, frames) for p, frames in zip(payloads, parts)]


def _grouped(work: list, size_of):
    group, total = [], 0
    for item in work:
        n = size_of(item)
        if group and total + n > GROUP:
            yield group
            group, total = [], 0
        group.append(item)
        total += n
    if group:
        yield group


def _stream(payload: bytes, frames: list[bytes]) -> bytes:
    flipped = (np.frombuffer(payload, dtype=np.uint8) ^ 0x80).tobytes()
    sizes = [len(f) for f in frames]
    packed = RATE << 44 | 7 << 36 | len(payload)
    info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
    info += packed.to_bytes(8, "big") + hashlib.md5(flipped).digest()
    points, offset = [], 0
    for i, n in enumerate(sizes):
        points.append(struct.pack(">QQH", i * BLOCK, offset, min(BLOCK, len(payload) - i * BLOCK)))
        offset += n
    seek = b"".join(points)
    return b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + b"".join(frames)


def parse(media: bytes) -> tuple[int, bytes, np.ndarray, int]:
    """Samples in all, their MD5, the seek points (sample, offset, size), first frame, of a
    stream with a seek point for each frame of ``BLOCK`` samples; others raise ``Unusual``."""
    head = flac_stream.head_of(media)
    at, seek = 4, b""
    while at < head.frames:
        size = int.from_bytes(media[at + 1 : at + 4], "big")
        seek = media[at + 4 : at + 4 + size] if media[at] & 0x7F == 3 else seek
        at += 4 + size
    if (head.block, head.rate, head.channels, head.bits) != ((BLOCK, BLOCK), RATE, 1, 8) or len(seek) % 18:
        raise Unusual("another kind of stream")
    points = np.array([struct.unpack_from(">QQH", seek, i) for i in range(0, len(seek), 18)], dtype=np.uint64).astype(np.int64)
    if len(points) != -(-head.total // BLOCK) or not len(points) or (points[:, 0] != np.arange(len(points)) * BLOCK).any():
        raise Unusual("no seek point for each frame")
    return head.total, head.md5, points, head.frames


def decode(streams: list[bytes]) -> list[bytes]:
    """The payloads of streams, or the PCM bytes of those of other encoders; raises FlacError
    where any checksum differs."""
    return [b"".join(pcm for _, pcm in blocks) for blocks in decode_blocks(streams)]


def decode_blocks(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """Of each stream its blocks: the number of the first sample, and the PCM bytes."""
    try:
        return [[(at, raw[at : at + BLOCK]) for at in range(0, len(raw), BLOCK)] for raw in _side_by_side(streams)]
    except Unusual:
        if len(streams) > 1:
            return [blocks for s in streams for blocks in decode_blocks([s])]
    head, blocks = flac_stream.read(streams[0])
    return [[(at, flac_stream.pcm(x, head.bits)) for at, x in blocks]]


def _side_by_side(streams: list[bytes]) -> list[bytes]:
    heads = [parse(s) for s in streams]
    work = [(i, j) for i, (_, _, points, _) in enumerate(heads) for j in range(len(points))]
    parts: list[list[np.ndarray]] = [[] for _ in streams]

    def bounds(i: int, j: int) -> tuple[int, int]:
        _, _, points, first = heads[i]
        return first + int(points[j, 1]), first + int(points[j + 1, 1]) if j + 1 < len(points) else len(streams[i])

    for group in _grouped(work, lambda w: int(heads[w[0]][2][w[1], 2])):
        spans = [bounds(i, j) for i, j in group]
        data = b"".join(streams[i][a:b] for (i, _), (a, b) in zip(group, spans))
        size = np.array([b - a for a, b in spans])
        if (size < 8).any():
            raise FlacError("a frame is cut")
        end = np.cumsum(size)
        for (i, _), x in zip(group, decode_frames(data, end - size, end, np.array([j for _, j in group]))):
            parts[i].append(x)
    out = []
    for (total, md5, _, _), own in zip(heads, parts):
        raw = np.concatenate(own)
        if len(raw) != total or hashlib.md5(raw.tobytes()).digest() != md5:
            raise FlacError("the samples' checksum differs")
        out.append((raw.view(np.uint8) ^ 0x80).tobytes())
    return out
