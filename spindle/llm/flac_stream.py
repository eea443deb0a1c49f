"""A reader for FLAC streams of any encoder, after the published format.

Frame after frame is read bit by bit: all block sizes and sample sizes, up to eight channels
and the three stereo forms, constant, verbatim, fixed and linear predictors of every order and
precision, wasted bits, both Rice codings with every partition order, and escaped partitions.
No seek table is needed.  The checksums of every frame header, every frame and all samples are
verified.  :mod:`spindle.llm.flac` reads the streams it wrote itself faster, side by side.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np


class FlacError(ValueError):
    """A stream that is not well-formed or fails a checksum."""


#: Values of the codes in a frame header (fixed values); 0 refers to the stream's head.
BLOCK_SIZES = {1: 192, 2: 576, 3: 1152, 4: 2304, 5: 4608, 8: 256, 9: 512, 10: 1024, 11: 2048, 12: 4096, 13: 8192, 14: 16384, 15: 32768}
SAMPLE_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}
RATES = {1: 88200, 2: 176400, 3: 192000, 4: 8000, 5: 16000, 6: 22050, 7: 24000, 8: 32000, 9: 44100, 10: 48000, 11: 96000}
#: Coefficients of the fixed predictors, the last sample first (fixed values).
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
LEFT_SIDE, SIDE_RIGHT, MID_SIDE = 8, 9, 10


def _table(bits: int, polynomial: int) -> list[int]:
    out, top = [], 1 << (bits - 1)
    for byte in range(256):
        c = byte << (bits - 8)
        for _ in range(8):
            c = c << 1 ^ polynomial if c & top else c << 1
        out.append(c & (1 << bits) - 1)
    return out


CRC8, CRC16 = _table(8, 0x07), _table(16, 0x8005)


def crc8(data: bytes) -> int:
    c = 0
    for byte in data:
        c = CRC8[c ^ byte]
    return c


def crc16(data: bytes) -> int:
    c = 0
    for byte in data:
        c = (c << 8 & 0xFFFF) ^ CRC16[c >> 8 ^ byte]
    return c


class Bits:
    """Bits of a byte string, the highest of each byte first."""

    def __init__(self, data: bytes, byte: int = 0):
        self.data, self.at, self.end = data, 8 * byte, 8 * len(data)

    def take(self, n: int) -> int:
        if self.at + n > self.end:
            raise FlacError("the stream is cut")
        first, last = self.at >> 3, (self.at + n + 7) >> 3
        self.at += n
        return int.from_bytes(self.data[first:last], "big") >> (8 * last - self.at) & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value - (1 << n) if n and value >> (n - 1) else value

    def zeros(self) -> int:
        """How many zeros stand before the next one; both are passed."""
        begin = self.at
        while True:
            if self.at >= self.end:
                raise FlacError("the stream is cut")
            first = self.at >> 3
            window = int.from_bytes(self.data[first : first + 8].ljust(8, b"\0"), "big") & (1 << 64 - (self.at & 7)) - 1
            if window:
                self.at = 8 * first + 64 - window.bit_length() + 1
                return self.at - 1 - begin
            self.at = 8 * first + 64


@dataclass
class Head:
    """What a stream says about all its frames."""

    block: tuple[int, int]
    rate: int
    channels: int
    bits: int
    total: int
    md5: bytes
    frames: int  # where the first frame begins


def head_of(media: bytes) -> Head:
    if media[:4] != b"fLaC":
        raise FlacError("not a FLAC stream")
    at, info, last = 4, b"", False
    while not last:
        if at + 4 > len(media):
            raise FlacError("the stream is cut")
        kind, size = media[at], int.from_bytes(media[at + 1 : at + 4], "big")
        last = bool(kind & 0x80)
        if kind & 0x7F == 0:
            info = media[at + 4 : at + 4 + size]
        at += 4 + size
    if len(info) != 34:
        raise FlacError("no stream info")
    bits = Bits(info)
    block = bits.take(16), bits.take(16)
    bits.take(48)  # sizes of the smallest and the largest frame
    return Head(block, bits.take(20), bits.take(3) + 1, bits.take(5) + 1, bits.take(36), info[18:], at)


def _residual(bits: Bits, size: int, order: int) -> list[int]:
    coding = bits.take(2)
    if coding > 1:
        raise FlacError("a reserved residual coding")
    width = 4 + coding
    parts = bits.take(4)
    each = size >> parts
    if each << parts != size or each < order:
        raise FlacError("partitions do not fit the block")
    out: list[int] = []
    for p in range(1 << parts):
        n, k = each - (0 if p else order), bits.take(width)
        if k == (1 << width) - 1:
            plain = bits.take(5)
            out += [bits.signed(plain) for _ in range(n)]
            continue
        for _ in range(n):
            u = bits.zeros() << k | bits.take(k)
            out.append(u >> 1 ^ -(u & 1))
    return out


def _restored(warm: list[int], residual: list[int], coefficients: tuple[int, ...], shift: int) -> list[int]:
    out, order = list(warm), len(coefficients)
    turned = coefficients[::-1]
    for r in residual:
        out.append(r + (sum(c * x for c, x in zip(turned, out[len(out) - order :])) >> shift))
    return out


def _subframe(bits: Bits, size: int, width: int) -> np.ndarray:
    if bits.take(1):
        raise FlacError("a subframe begins with a one")
    kind = bits.take(6)
    wasted = bits.zeros() + 1 if bits.take(1) else 0
    width -= wasted
    if width < 1:
        raise FlacError("no bits are left of a sample")
    if kind == 0:
        own = [bits.signed(width)] * size
    elif kind == 1:
        own = [bits.signed(width) for _ in range(size)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        if order > size:
            raise FlacError("more predecessors than samples")
        warm = [bits.signed(width) for _ in range(order)]
        if kind < 32:
            coefficients, shift = FIXED[order], 0
        else:
            precision = bits.take(4) + 1
            shift = bits.signed(5)
            if precision == 16 or shift < 0:
                raise FlacError("a reserved precision or shift")
            coefficients = tuple(bits.signed(precision) for _ in range(order))
        own = _restored(warm, _residual(bits, size, order), coefficients, shift)
    else:
        raise FlacError("a reserved subframe")
    return np.array(own, dtype=np.int64) << wasted


def _number(bits: Bits) -> int:
    """A frame's or sample's number in the extended UTF-8 form."""
    lead = bits.take(8)
    if lead < 0x80:
        return lead
    more = 7 - (lead ^ 0xFF).bit_length()
    if not 1 <= more <= 6:
        raise FlacError("a broken number")
    value = lead & (0x3F >> more)
    for _ in range(more):
        byte = bits.take(8)
        if byte >> 6 != 2:
            raise FlacError("a broken number")
        value = value << 6 | byte & 0x3F
    return value


def read_frame(media: bytes, at: int, head: Head) -> tuple[int, int, np.ndarray]:
    """The frame at byte ``at``: its first sample's number, samples (size, channels), its end."""
    bits = Bits(media, at)
    if bits.take(15) != 0x7FFC:
        raise FlacError("no frame where one must begin")
    variable = bits.take(1)
    size_code, rate_code, layout, sample_code, reserved = bits.take(4), bits.take(4), bits.take(4), bits.take(3), bits.take(1)
    number = _number(bits)
    if size_code == 0 or rate_code == 15 or layout > MID_SIDE or sample_code == 3 or reserved:
        raise FlacError("a reserved code in a frame header")
    size = bits.take(8 if size_code == 6 else 16) + 1 if size_code in (6, 7) else BLOCK_SIZES[size_code]
    if rate_code >= 12:
        bits.take(8 if rate_code == 12 else 16)
    if bits.take(8) != crc8(media[at : (bits.at >> 3) - 1]):
        raise FlacError("a frame header's checksum differs")
    width = SAMPLE_BITS.get(sample_code, head.bits)
    channels = layout + 1 if layout < LEFT_SIDE else 2
    side = {LEFT_SIDE: 1, SIDE_RIGHT: 0, MID_SIDE: 1}.get(layout)
    x = [_subframe(bits, size, width + (c == side)) for c in range(channels)]
    if layout == LEFT_SIDE:
        x[1] = x[0] - x[1]
    elif layout == SIDE_RIGHT:
        x[0] = x[0] + x[1]
    elif layout == MID_SIDE:
        both = x[0] << 1 | x[1] & 1
        x = [both + x[1] >> 1, both - x[1] >> 1]
    end = (bits.at + 7) // 8 + 2
    if end > len(media) or crc16(media[at:end]):
        raise FlacError("a frame's checksum differs")
    first = number if variable else number * head.block[0]
    return first, end, np.stack(x, axis=1)


def read(media: bytes) -> tuple[Head, list[tuple[int, np.ndarray]]]:
    """A whole stream: its head, and of each frame the number of its first sample and the
    samples as (size, channels).  Frames must follow one another without a gap."""
    head = head_of(media)
    at, blocks, digest, seen = head.frames, [], hashlib.md5(), 0
    wide = (head.bits + 7) // 8
    while at < len(media):
        first, at, x = read_frame(media, at, head)
        if first != seen or x.shape[1] != head.channels:
            raise FlacError("a frame out of place")
        digest.update(x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes())
        blocks.append((seen, x))
        seen += len(x)
    if (head.total and head.total != seen) or (any(head.md5) and digest.digest() != head.md5):
        raise FlacError("the samples' checksum differs")
    return head, blocks


def pcm(x: np.ndarray, bits: int) -> bytes:
    """Samples as they stand in a WAVE file: 8 bits without sign, more with, lowest byte first."""
    if bits <= 8:
        return (x + 128).astype(np.uint8).tobytes()
    return x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()
