"""Vectorised pre-tokenisation for byte-level BPE vocabularies.

The published split pattern (contractions, then an optional blank with a run of
letters, of numbers or of other signs, then white space) is evaluated on whole
arrays of code points: every code point is mapped to one of four classes, and a
token starts wherever the class sequence says so.  No regular expression runs
over the text, so the cost is a few array passes per batch.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

#: Code points that the Unicode property White_Space holds (fixed values).
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point by its Unicode general category.

    Python, ``regex`` and ``tokenizers`` follow different Unicode versions; where
    the first two disagree (recently assigned letters), ``tokenizers`` decides.
    """
    table = np.zeros(0x110000, dtype=np.uint8)
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    every = "".join(map(chr, points))
    for kind, letters in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(letters, every):
            table[points[run.start()] : points[run.end() - 1] + 1] = kind
    kinds = {"L": LETTER, "N": NUMBER}
    known = np.fromiter((kinds.get(unicodedata.category(c)[0], OTHER) for c in every), np.uint8, len(every))
    asked = ByteLevel(add_prefix_space=False, use_regex=True)
    for c in points[known != table[points]].tolist():
        joins = {tuple(span) for _, span in asked.pre_tokenize_str(f"a1{chr(c)}b")}
        table[c] = NUMBER if (1, 3) in joins else LETTER if (2, 4) in joins else OTHER
    table[list(WHITE_SPACE)] = SPACE
    return table


def split_points(joined: str, separators: np.ndarray) -> np.ndarray:
    """Start offsets of all tokens of ``joined``; ``separators`` are offsets of
    newlines that stand between texts (each becomes a token of its own, and a
    text's end counts as an end of input)."""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(points)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    cls = class_table()[points]
    space = cls == SPACE
    start = np.empty(n, dtype=bool)
    start[0] = True
    same = cls[1:] == cls[:-1]
    # A run of one class starts a token, unless one blank before it joins in.
    np.logical_not(same, out=start[1:])
    start[1:] &= space[1:] | (points[:-1] != 0x20)
    # The last white space before other text parts from its run.
    last = space[1:-1] & space[:-2] & ~space[2:] if n > 2 else np.zeros(0, dtype=bool)
    if n > 2:
        start[1:-1] |= last
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        _contractions(points, cls, start, marks)
    if len(separators):
        start[separators] = True
        after = separators + 1
        start[after[after < n]] = True
    return np.flatnonzero(start)


def _contractions(points: np.ndarray, cls: np.ndarray, start: np.ndarray, marks: np.ndarray) -> None:
    n = len(points)
    first = marks[start[marks]]
    get = lambda k: np.where(first + k < n, points[np.minimum(first + k, n - 1)], 0)
    a, b = get(1), get(2)
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    for hit, size in ((one, 2), (two, 3)):
        at = first[hit]
        start[at + 1] = False
        end = at + size
        start[end[end < n]] = True


def tokens_of(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All tokens of all texts in order, and the bounds of each text's tokens:
    text ``i`` has ``tokens[bounds[2 * i]:bounds[2 * i + 1]]``."""
    joined = "\n".join(texts)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes + 1) - 1
    at = split_points(joined, ends[:-1])
    stops = at[1:].tolist()
    stops.append(len(joined))
    starts = at.tolist() if len(at) else []
    tokens = [joined[a:b] for a, b in zip(starts, stops)]
    bounds = np.empty(2 * len(texts), dtype=np.int64)
    bounds[0::2] = np.searchsorted(at, ends - sizes)
    bounds[1::2] = np.searchsorted(at, ends)
    return tokens, bounds
