"""Token counts under a unigram model, with a trie of the distinct pre-tokens.

The best segmentation of a pre-token is found by dynamic programming over its
bytes.  Pre-tokens that share a prefix share all of its states: a batch's distinct
pre-tokens form a trie, the forward scores are computed once per trie node, level
by level in numpy, and each pre-token reads its count at its terminal node.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spindle.llm._common import read_bytes, slices, tidied
from spindle.llm.bpe import ByteBPE, loaded, room
from spindle.llm.pretokens import tokens_of


def zipf_scores(n: int) -> np.ndarray:
    """Log weights of a vocabulary that is ordered by frequency (Zipf's law)."""
    return -np.log(np.arange(n, dtype=np.float64) + 2.7)


class UnigramTrie:
    """A vocabulary of byte strings as a trie, and the forward pass over words.

    ``vocabulary`` must hold all 256 single bytes, so that every word has a
    segmentation.  Of equal scores the smaller count wins."""

    def __init__(self, vocabulary: dict[bytes, int], scores: np.ndarray, cache_words: int = 500_000):
        if any(bytes([b]) not in vocabulary for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        index: dict[tuple[int, int], int] = {}
        value = {}
        for token, i in vocabulary.items():
            node = 0
            for b in token:
                node = index.setdefault((node, b), len(index) + 1)
            value[node] = scores[i]
        keys = np.array([a * 256 + b for a, b in index], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(index.values()), dtype=np.int64)[order]
        self.score = np.full(len(index) + 1, -np.inf)
        self.score[list(value)] = list(value.values())
        self.cache_words = cache_words
        self.cache: dict[str, int] = {}
        self.held = 0

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child nodes, or 0 (the root is nobody's child)."""
        keys = node * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.child[at], 0)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens in the best segmentation of each distinct word."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        result = np.zeros(len(words), dtype=np.int64)
        live = np.flatnonzero(sizes > 0)
        place = np.zeros(len(live), dtype=np.int64)  # trie node of each live word, numbered within its level
        # Of each node: the matches under way, as (vocabulary node, score and count where it began).
        pointer = np.array([0, 1])
        state, base, tokens = np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64)
        depth = 0
        while len(live):
            keys, place = np.unique(place * 256 + data[begin[live] + depth], return_inverse=True)
            parent, byte = keys // 256, keys % 256
            wide = pointer[parent + 1] - pointer[parent]
            owner = np.repeat(np.arange(len(keys)), wide)
            first = np.cumsum(wide) - wide
            take = np.repeat(pointer[parent] - first, wide) + np.arange(len(owner))
            moved = self.step(state[take], byte[owner])
            on = moved > 0
            owner, moved, base, tokens = owner[on], moved[on], base[take][on], tokens[take][on]
            total = base + self.score[moved]
            heads = np.searchsorted(owner, np.arange(len(keys)))
            best = np.maximum.reduceat(total, heads)
            fewest = np.minimum.reduceat(np.where(total == best[owner], tokens + 1, np.iinfo(np.int64).max), heads)
            # The node's own score starts new matches at the vocabulary's root.
            spot = np.append(heads[1:], len(owner))
            state, base, tokens = np.insert(moved, spot, 0), np.insert(base, spot, best), np.insert(tokens, spot, fewest)
            pointer = np.append(heads, len(owner)) + np.arange(len(keys) + 1)
            depth += 1
            ended = sizes[live] == depth
            result[live[ended]] = fewest[place[ended]]
            live, place = live[~ended], place[~ended]
        return result

    def learn(self, tokens: list[str]) -> None:
        seen = set(tokens)
        new = [t for t in seen if t not in self.cache]
        self.held += room(new)
        if self.held > self.cache_words:
            self.cache = {t: self.cache[t] for t in seen if t in self.cache}
            self.held = room(list(seen))
        self.cache.update(zip(new, self.count([t.encode("utf-8", "surrogatepass") for t in new]).tolist()))


@lru_cache(maxsize=2)
def unigram(bpe: ByteBPE) -> UnigramTrie:
    return UnigramTrie(bpe.id_of, zipf_scores(bpe.base))


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_pretokens, n_tokens`` of every whole text under the unigram model.

    A null or empty text has none; repeated rows give repeated results; an empty table gives
    none.  Other columns, whatever their names, are not read.  Time is linear in a text's
    length, and about 50 microseconds a byte within one very long pre-token."""
    raw = docs.sparkSession.sparkContext.broadcast(read_bytes(docs.sparkSession, tokenizer))

    def run(batches):
        trie = unigram(loaded(raw.value))
        for batch in batches:
            words, counts = [], []
            for _, texts in slices(batch, 1):
                tokens, bounds = tokens_of(texts)
                trie.learn(tokens)
                each = np.fromiter(map(trie.cache.__getitem__, tokens), dtype=np.int64, count=len(tokens))
                total = np.concatenate(([0], np.cumsum(each)))
                words.extend((bounds[1::2] - bounds[0::2]).tolist())
                counts.extend((total[bounds[1::2]] - total[bounds[0::2]]).tolist())
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.record_batch(columns, names=[id_col, "n_pretokens", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidied(run), f"`{id_col}` {kind}, n_pretokens long, n_tokens long")
