"""Personal data: format-preserving pseudonyms from a keyed Feistel permutation.

Every validated value is permuted within the set of values of its own format: digits
stay digits, separators stay, a card number keeps a valid check digit, an address keeps
octets up to 255, a date stays a date of the calendar.  The permutation depends only on
key, kind and value, so equal values get equal pseudonyms in all documents, and
different values different ones.
"""

from __future__ import annotations

import datetime
import hashlib
import heapq
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spindle.llm._common import slices, tidied

ROUNDS = 8
DAYS = (datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal())
KINDS = ("email", "card", "phone", "ip", "date", "ssn", "iban", "secret")


def feistel(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of ``range(size)``: a balanced Feistel network over the next
    even number of bits, walked until the value falls into the range."""
    if not 0 <= value < size:
        raise ValueError("value outside its range")
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            data = bytes([r]) + right.to_bytes(width, "big") + tweak
            mixed = hashlib.blake2b(data, key=key, digest_size=max(8, width)).digest()
            left, right = right, left ^ int.from_bytes(mixed, "big") & mask
        value = left << half | right
        if value < size:
            return value


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` and it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    own = iter(digits)
    return "".join(next(own) if c.isdigit() else c for c in shape)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _permuted(digits: str, key: bytes, tweak: bytes) -> str:
    return str(feistel(int(digits), 10 ** len(digits), key, tweak + str(len(digits)).encode())).zfill(len(digits))


def card(value: str, key: bytes) -> str | None:
    """13 to 19 digits with a valid check digit; the first digit and the check stay in
    form.  A run of exactly 16 digits with a wrong check digit is permuted as a number."""
    d = _digits(value)
    if not 13 <= len(d) <= 19:
        return None
    if luhn_digit(d[:-1]) == d[-1]:
        body = d[0] + _permuted(d[1:-1], key, b"card" + d[:1].encode())
        return _refill(value, body + luhn_digit(body))
    if len(d) != 16:
        return None
    body = d
    while True:  # walk on to a number that is not a valid card either
        body = _permuted(body, key, b"account")
        if luhn_digit(body[:-1]) != body[-1]:
            return _refill(value, body)


def phone(value: str, key: bytes) -> str | None:
    """10 national digits, with or without +1; the first and the fourth stay 0 or 1, or 2 to
    9, as they were.  Digits that only look like a number (no + and no parenthesis) have 2 to
    9 as the first.  Other international numbers keep their country code."""
    d = _digits(value)
    if value.lstrip().startswith("+") and not (d.startswith("1") and len(d) == 11):
        if not 8 <= len(d) <= 15:
            return None
        return _refill(value, d[:2] + _permuted(d[2:], key, b"phone+" + d[:2].encode()))
    head, own = d[:-10], d[-10:]
    if len(own) != 10 or head not in ("", "1") or own[0] in "01" and "+" not in value and "(" not in value:
        return None
    low = own[0] in "01", own[3] in "01"
    while True:
        own = _permuted(own, key, b"phone")
        if (own[0] in "01", own[3] in "01") == low:
            return _refill(value, head + own)


def ip(value: str, key: bytes) -> str | None:
    parts = value.split(".")
    if len(parts) != 4 or any(len(p) > 3 or int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    number = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, feistel(number, 1 << 32, key, b"ip").to_bytes(4, "big")))


def date(value: str, key: bytes) -> str | None:
    """Calendar dates of 1900 to 2099, year first, or day or month first with the year
    last; the order is kept."""
    found = re.fullmatch(r"(\d{1,4})([-/.])(\d{1,2})\2(\d{1,4})", value)
    if not found:
        return None
    a, sep, b, c = found.groups()
    orders = ((0, 1, 2),) if len(a) == 4 else ((2, 1, 0), (2, 0, 1)) if len(c) == 4 else ()
    fields = (a, b, c)
    for order in orders:
        try:
            day = datetime.date(*(int(fields[i]) for i in order)).toordinal()
        except ValueError:
            continue
        if not DAYS[0] <= day <= DAYS[1]:
            continue
        while True:
            day = DAYS[0] + feistel(day - DAYS[0], DAYS[1] - DAYS[0] + 1, key, b"date")
            new = datetime.date.fromordinal(day)
            # Of day-first and month-first forms each maps onto itself.
            if order != (2, 0, 1) or new.day > 12:
                break
        parts = {order[0]: f"{new.year:04d}", order[1]: f"{new.month:02d}", order[2]: f"{new.day:02d}"}
        return sep.join(parts[i] for i in range(3))
    return None


def ssn(value: str, key: bytes) -> str | None:
    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    d = _digits(value)
    if len(d) != 9 or not valid(d):
        return None
    while True:
        d = _permuted(d, key, b"ssn")
        if valid(d):
            return _refill(value, d)


def iban(value: str, key: bytes) -> str | None:
    raw = value.replace(" ", "").upper()
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(raw) <= 34 or number(raw[4:] + raw[:4]) % 97 != 1:
        return None
    body = _alnum(raw[4:], key, b"iban" + raw[:2].encode())
    check = 98 - number(body + raw[:2] + "00") % 97
    own = iter(raw[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(own) for c in value)


def _alnum(text: str, key: bytes, tweak: bytes) -> str:
    """Letters and digits permuted together, each place within its own alphabet."""
    sets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    of = {c: s for s in sets for c in s}
    number, size, shape = 0, 1, []
    for c in text:
        s = of.get(c)
        shape.append("x" if s is None else s[0])
        if s:
            number, size = number * len(s) + s.index(c), size * len(s)
    number = feistel(number, size, key, tweak + "".join(shape).encode()) if size > 1 else number
    out = []
    for c in reversed(text):
        s = of.get(c)
        if s:
            number, i = divmod(number, len(s))
            out.append(s[i])
        else:
            out.append(c)
    return "".join(reversed(out))


def email(value: str, key: bytes) -> str | None:
    """The local part is permuted, the domain stays."""
    local, _, domain = value.rpartition("@")
    return f"{_alnum(local, key, b'email@' + domain.lower().encode())}@{domain}"


def secret(value: str, key: bytes) -> str | None:
    """Keys and passwords that a text assigns; the name stays, the value is permuted
    within its alphabet (hexadecimal digits among themselves)."""
    if value.startswith("AKIA"):
        return "AKIA" + _alnum(value[4:], key, b"AKIA")
    found = re.fullmatch(r"(?s)(.*?[=:]\s*[\"']?)([^\"']+)([\"']?)", value)
    if not found or len(found[2]) < 8:
        return None
    head, own, tail = found.groups()
    if re.fullmatch(r"[0-9a-f]+", own):
        n = len(own)
        own = format(feistel(int(own, 16), 16**n, key, b"hex%d" % n), f"0{n}x")
    else:
        own = _alnum(own, key, b"secret")
    return head + own + tail


#: Patterns of the kinds, the first that matches and validates wins.
PATTERNS: tuple[tuple[str, str, Callable[[str, bytes], str | None]], ...] = (
    ("secret", r"\b(?:token|password|passwd|secret|api[_-]?key|access[_-]?key|auth)\b\s*[=:]\s*(?:\"[^\"\s]{8,}\"|'[^'\s]{8,}'|[A-Za-z0-9+/_\-]{8,}={0,2})", secret),
    ("secret", r"\bAKIA[0-9A-Z]{16}\b", secret),
    ("email", r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b", email),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    ("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)", ip),
    ("date", r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-]|\.\d)", date),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", ssn),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])", card),
    ("phone", r"(?<![\w.-])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w.])\+\d{1,3}[ .-]?(?:\(?\d{1,4}\)?[ .-]?){1,5}\d{2,4}(?![\w-])", phone),
)


@lru_cache(maxsize=1)
def _compiled():
    return [(kind, re.compile(p, re.ASCII | (re.IGNORECASE if kind == "secret" else 0)), f) for kind, p, f in PATTERNS]


class Pseudonymizer:
    """Replaces all values of the known kinds in texts; ``key`` names the permutation."""

    def __init__(self, key: bytes, cache_values: int = 100_000):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.cache: dict[tuple[str, str], str | None] = {}
        self.cache_values = cache_values

    def value(self, kind: str, text: str, make: Callable[[str, bytes], str | None]) -> str | None:
        at = (kind, text)
        if at not in self.cache:
            if len(self.cache) >= self.cache_values:
                self.cache.clear()
            self.cache[at] = make(text, self.key)
        return self.cache[at]

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind it had.  A match that overlaps
        a value that an earlier pattern took is none."""
        counts: dict[str, int] = {}
        spans: list[tuple[int, int, str]] = []  # in order; they do not overlap
        for kind, pattern, make in _compiled():
            found, at = [], 0
            for m in pattern.finditer(text):
                a, b = m.span()
                while at < len(spans) and spans[at][1] <= a:
                    at += 1
                if at < len(spans) and spans[at][0] < b:
                    continue
                new = self.value(kind, m.group(), make)
                if new is not None:
                    found.append((a, b, new))
            if found:
                counts[kind] = counts.get(kind, 0) + len(found)
                spans = list(heapq.merge(spans, found))
        if not spans:
            return text, counts
        out, at = [], 0
        for a, b, new in spans:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]), counts


def pseudonymized(docs: DataFrame, key: bytes, text_col: str = "text", counts: bool = False) -> DataFrame:
    """All columns of ``docs`` with the values in ``text_col`` replaced.

    A null text stays null, an empty one empty; repeated rows stay alike; an empty table
    gives an empty one.  Time grows with the length of a text and of its values.  With
    ``counts``, columns ``n_<kind>`` follow; columns of these names are replaced."""
    extra = [f"n_{k}" for k in KINDS] if counts else []
    docs = docs.drop(*extra)
    at = docs.columns.index(text_col)

    def run(batches):
        own = Pseudonymizer(key)
        for batch in batches:
            valid = batch.column(at).is_valid()
            for first, texts in slices(batch, at):
                here = batch.slice(first, len(texts))
                done = [own.text(t) for t in texts]
                new = pa.array([t for t, _ in done], type=batch.schema.field(at).type)
                columns = list(here.columns)
                columns[at] = pc.if_else(valid.slice(first, len(texts)), new, pa.scalar(None, new.type))
                columns += [pa.array([c.get(k, 0) for _, c in done], pa.int64()) for k in KINDS[: len(extra)]]
                yield pa.record_batch(columns, names=[*batch.schema.names, *extra])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in extra)])
    return docs.mapInArrow(tidied(run), schema)
