"""Byte-pair encoding by speculation and verification, and decoding.

A greedy longest match over the vocabulary proposes the tokens of a word.  A
proposal is the true merge result exactly when every adjacent pair of its tokens
is *compatible*, i.e. the two neighbours, merged in rank order, would never have
joined across their boundary.  That test needs only the merge tree, so it runs
on all adjacent pairs of all proposals at once in numpy.  Words with a failing
pair are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from tiktoken_ext.openai_public import r50k_pat_str

from spindle.llm._common import read_bytes, slices, tidied
from spindle.llm.pretokens import tokens_of

NONE = np.int64(1) << 40


def room(words: list[str]) -> int:
    """How many places words take in a cache: one each and one for each 64 characters, so
    that a cache is bounded in bytes too."""
    return len(words) + sum(map(len, words)) // 64


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that
    print stand for themselves, the others follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A byte-level BPE vocabulary; built from the bytes of a tokenizer file."""

    def __init__(self, raw: bytes, cache_words: int = 500_000):
        spec = json.loads(raw)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            self.token_bytes[i] = text.encode()
        self.id_of = {self.token_bytes[i]: i for i in vocab.values()}
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            i, j, whole = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((i, j), (r, whole))
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = r, i, j
        self.base = size
        keys = np.array([a * size + b for a, b in self.merge], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merge.values()], dtype=np.int64)[order]
        self._self_encoding()
        self.cache_words = cache_words
        self.cache: dict[str, bytes] = {}
        self.held = 0

    def _self_encoding(self) -> None:
        """Drop from the proposals every token that merging its own bytes would not give."""
        made = np.flatnonzero(self.rank >= 0)
        ok = np.ones(self.base, dtype=bool)
        ok[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for i in made[np.argsort(self.rank[made])]:
            ok[i] &= ok[self.left[i]] and ok[self.right[i]]
        single = set(self.byte_id)
        self.proposals = {b: i for b, i in self.id_of.items() if ok[i] and (self.rank[i] >= 0 or i in single)}
        self.longest = max(map(len, self.proposals))

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.base + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` stay apart, for all pairs at once.

        The two merge trees are unwound from the last merge to the first; ``x`` and
        ``y`` are the pieces that touch at the boundary at that moment.  They join if
        their merge comes before the merges that consume ``x`` and ``y`` (on a tie the
        left place goes first).  ``within``: only merges of a lower rank count.
        """
        n = len(a)
        good = np.ones(n, dtype=bool)
        live, x, y = np.arange(n), a.astype(np.int64), b.astype(np.int64)
        until_x = np.full(n, NONE) if within is None else within.astype(np.int64)
        until_y = np.full(n, NONE - 1) if within is None else within.astype(np.int64) - 1
        while len(live):
            r = self.merge_rank(x, y)
            bad = (r < until_x) & (r <= until_y)
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            keep = ~bad & ((rx >= 0) | (ry >= 0))
            live, x, y, until_x, until_y, rx, ry = (v[keep] for v in (live, x, y, until_x, until_y, rx, ry))
            split_x = rx > ry
            until_x, until_y = np.where(split_x, rx, until_x), np.where(split_x, until_y, ry)
            x, y = np.where(split_x, self.right[x], x), np.where(split_x, y, self.left[y])
        return good

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        get, n, at, out = self.proposals.get, len(word), 0, []
        whole = get(word)
        if whole is not None:
            return [whole]
        while at < n:
            end = min(n, at + self.longest)
            token = get(word[at:end])
            while token is None:
                end -= 1
                token = get(word[at:end])
            out.append(token)
            at = end
        return out

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, from the left, with a heap of pairs."""
        ids = [self.byte_id[b] for b in word]
        n, merge = len(ids), self.merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            r, i, whole = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or merge.get((ids[i], ids[j])) != (r, whole):
                continue
            ids[i], ids[j] = whole, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merge.get((whole, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merge.get((ids[h], whole))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        proposed = list(map(self.propose, words))
        sizes = np.fromiter(map(len, proposed), dtype=np.int64, count=len(proposed))
        flat = np.fromiter((i for p in proposed for i in p), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = owner[1:] == owner[:-1]
        pairs, place = np.unique(flat[:-1][inner] * self.base + flat[1:][inner], return_inverse=True)
        good = self.compatible(pairs // self.base, pairs % self.base)
        for w in np.unique(owner[:-1][inner][~good[place]]):
            proposed[w] = self.merged(words[w])
        return proposed

    def _learn(self, tokens: list[str]) -> None:
        """Adds the words of a batch to the cache; a full cache keeps only those of the batch."""
        cache, seen = self.cache, set(tokens)
        new = [t for t in seen if t not in cache]
        self.held += room(new)
        if self.held > self.cache_words:
            kept = {t: cache[t] for t in seen if t in cache}
            cache.clear()
            cache.update(kept)
            self.held = room(list(seen))
        words = [t.encode("utf-8", "surrogatepass") for t in new]
        cache.update(zip(new, map(packed, self.encode_words(words))))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit integers."""
        parts, owners = [], []
        for k, text in enumerate(texts):
            for part, mark in self._segments(text):
                owners.append((k, mark))
                parts.append(part)
        tokens, bounds = tokens_of(parts)
        self._learn(tokens)
        get, b = self.cache.__getitem__, bounds.tolist()
        out: list[list[bytes]] = [[] for _ in texts]
        for i, (k, mark) in enumerate(owners):
            out[k] += map(get, tokens[b[2 * i] : b[2 * i + 1]])
            if mark is not None:
                out[k].append(int(mark).to_bytes(4, "little"))
        return [b"".join(own) for own in out]

    def _segments(self, text: str):
        """Pieces of a text between special tokens, each with the id that follows it.  Of
        special tokens that begin at one place the longest counts."""
        at = 0
        for found in self.marks.finditer(text) if self.special else ():
            yield text[at : found.start()], self.special[found.group()]
            at = found.end()
        yield text[at:], None

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens kept; ids outside the vocabulary give nothing."""
        table, n = self.token_bytes, self.base
        try:
            raw = b"".join(map(table.__getitem__, ids))
        except IndexError:
            raw = b"".join(table[i] for i in ids if 0 <= i < n)
        return raw.decode("utf-8", "replace")


class LibraryBPE(ByteBPE):
    """The same vocabulary, with a library's merging.

    The library also cuts the texts that are sure to be cut alike: those of Latin-1 signs, whose
    classes are the same in all versions of Unicode, up to a length at which its regular
    expressions cannot run out of room.  The others are cut as by :class:`ByteBPE`."""

    LONGEST = 100_000  # signs

    def __init__(self, raw: bytes, cache_words: int = 300_000):
        super().__init__(raw, cache_words)
        self.whole = tiktoken.Encoding("texts", pat_str=r50k_pat_str, mergeable_ranks=self.id_of, special_tokens={})
        self.piece = self.whole._core_bpe

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        return list(map(self.piece.encode_single_piece, words))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        plain = [len(t) <= self.LONGEST and in_latin_1(t) and not any(s in t for s in self.special) for t in texts]
        others = iter(super().encode_batch([t for t, ok in zip(texts, plain) if not ok]))
        return [packed(self.whole.encode_ordinary(t)) if ok else next(others) for t, ok in zip(texts, plain)]


def in_latin_1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=4)
def loaded(raw: bytes, kind: type = ByteBPE) -> ByteBPE:
    """One encoder per process and vocabulary."""
    return kind(raw)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids array<int>`` of every whole text.  A null text counts as
    empty and gives no ids; repeated rows give repeated results."""
    raw = docs.sparkSession.sparkContext.broadcast(read_bytes(docs.sparkSession, tokenizer))

    def run(batches):
        bpe = loaded(raw.value)
        for batch in batches:
            for at, texts in slices(batch, 1):
                out = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in bpe.encode_batch(texts)]
                ids = pa.array(out, type=pa.list_(pa.int32()))
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), ids], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidied(run), f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of every row of ids; null ids give an empty text."""
    raw = tokens.sparkSession.sparkContext.broadcast(read_bytes(tokens.sparkSession, tokenizer))

    def run(batches):
        bpe = loaded(raw.value)
        for batch in batches:
            texts = [bpe.decode([i for i in ids.as_py() or [] if i is not None]) for ids in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(id_col, ids_col).mapInArrow(tidied(run), f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text, decodes the ids again, and returns the number of
    ids with digests of the ids and of the decoded text.  Both directions run in one
    pass, so the ids never leave the worker.  Nulls as in :func:`encode`; an empty table gives
    no rows; other columns, whatever their names, are not read.  Time is linear in a text's
    length; a text, its tokens and its ids are in memory at one time."""
    raw = docs.sparkSession.sparkContext.broadcast(read_bytes(docs.sparkSession, tokenizer))

    def run(batches):
        bpe = loaded(raw.value)
        number = [str(i) for i in range(bpe.base)].__getitem__
        for batch in batches:
            count, of_ids, of_text = [], [], []
            for _, texts in slices(batch, 1):
                for encoded in bpe.encode_batch(texts):
                    ids = np.frombuffer(encoded, dtype="<u4").tolist()
                    count.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(number, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.record_batch(columns, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(tidied(run), schema)
