"""Quality: a byte-level convolutional network in numpy.

A text's bytes are embedded; one more channel tells whether a byte's word repeats
the word before it.  Learned filters of ``2 * STRIDE`` bytes run over the whole text
every ``STRIDE`` bytes, their responses are averaged within overlapping chunks, a
second layer scores each chunk, and the maxima over all chunks are combined into one
probability.  Long texts are processed in pieces with running maxima.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm._common import slices, tidied
from spindle.llm.training import in_fold, labelled_sample

EMBED, STRIDE, FILTERS, HIDDEN = 6, 4, 24, 16
HALF = 32  # filter positions in half a chunk; chunks overlap by half
PIECE = HALF * STRIDE * 4096
RADIX = np.uint64(0x9E3779B97F4A7C15)


def repeats(b: np.ndarray) -> np.ndarray:
    """Which bytes lie in a word that equals the word before it."""
    n, out = len(b), np.zeros(len(b), dtype=np.float32)
    inside = np.concatenate(([False], b > 32, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[0::2], edge[1::2]
    if len(begin) < 2:
        return out
    power = np.multiply.accumulate(np.full(n, RADIX, dtype=np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power)))
    word, size = total[end] - total[begin], end - begin
    same = (size[1:] == size[:-1]) & (word[1:] == word[:-1] * power[begin[1:] - begin[:-1] - 1])
    change = np.zeros(n + 1, dtype=np.int32)
    change[begin[1:][same]] += 1
    change[end[1:][same]] -= 1
    return np.cumsum(change[:n]).astype(np.float32)


@dataclass
class QualityNet:
    embed: np.ndarray  # 256 x EMBED
    first: np.ndarray  # STRIDE * (EMBED + 1) x FILTERS, for the first half of a filter
    second: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray  # 1

    NAMES = ("embed", "first", "second", "bias", "hidden", "hidden_bias", "out", "out_bias")

    @classmethod
    def initial(cls, seed: int = 7) -> QualityNet:
        rng = np.random.default_rng(seed)
        f = lambda *shape: (rng.standard_normal(shape) * np.sqrt(1.5 / shape[0])).astype(np.float32)
        wide = STRIDE * (EMBED + 1)
        z = lambda n: np.zeros(n, dtype=np.float32)
        embed = rng.standard_normal((256, EMBED)).astype(np.float32) * 0.5
        return cls(embed, f(wide, FILTERS), f(wide, FILTERS), z(FILTERS), f(FILTERS, HIDDEN) * 3, z(HIDDEN), f(HIDDEN), z(1))

    def chunks(self, b: np.ndarray):
        """Of a piece of bytes: the blocks of inputs, filter responses and chunk means."""
        n = max(2, -(-len(b) // STRIDE))
        padded = np.zeros(n * STRIDE, dtype=np.uint8)
        padded[: len(b)] = b
        x = np.concatenate((self.embed[padded], repeats(padded)[:, None]), axis=1).reshape(n, -1)
        z = x[:-1] @ self.first
        z += x[1:] @ self.second
        z += self.bias
        np.maximum(z, 0, out=z)
        sums = np.add.reduceat(z, np.arange(0, n - 1, HALF), axis=0)
        size = np.diff(np.append(np.arange(0, n - 1, HALF), n - 1)).astype(np.float32)
        if len(sums) > 1:
            sums, size = sums[:-1] + sums[1:], size[:-1] + size[1:]
        return padded, x, z, sums / size[:, None], size

    def top(self, means: np.ndarray) -> np.ndarray:
        return np.maximum(means @ self.hidden + self.hidden_bias, 0)

    @staticmethod
    def pieces(b: np.ndarray) -> range:
        """Where the pieces begin; they share one chunk's length, so every chunk is seen whole."""
        step = PIECE - HALF * STRIDE * 2
        return range(0, max(1, len(b) - HALF * STRIDE * 2 if len(b) > PIECE else 1), step)

    def logit(self, text: bytes) -> float:
        b, best = np.frombuffer(text or b"\x00", dtype=np.uint8), np.zeros(HIDDEN, dtype=np.float32)
        for at in self.pieces(b):
            best = np.maximum(best, self.top(self.chunks(b[at : at + PIECE])[3]).max(axis=0))
        return float(best @ self.out + self.out_bias[0])

    def score(self, text: str) -> float:
        v = np.clip(self.logit(text.encode("utf-8", "surrogatepass")), -50, 50)
        return float(1 / (1 + np.exp(-v)))

    def gradients(self, text: bytes, y: float, weight: float) -> dict[str, np.ndarray]:
        """Of the weighted log loss; only the chunks that hold a maximum get any."""
        b = np.frombuffer(text or b"\x00", dtype=np.uint8)
        best, at, piece = None, None, np.zeros(HIDDEN, dtype=np.int64)  # of each maximum: its chunk and piece
        for begin in self.pieces(b):
            parts = self.chunks(b[begin : begin + PIECE])
            h = self.top(parts[3])
            own = h.argmax(axis=0)
            top = h[own, np.arange(HIDDEN)]
            if best is None:
                best, at = top, own
            else:
                more = top > best
                best, at, piece = np.where(more, top, best), np.where(more, own, at), np.where(more, begin, piece)
        logit = float(best @ self.out + self.out_bias[0])
        r = weight * (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y)
        g = {"out": r * best, "out_bias": np.array([r], dtype=np.float32)}
        dh = r * self.out * (best > 0)
        g["hidden"], g["hidden_bias"] = np.zeros_like(self.hidden), dh
        g["first"], g["second"], g["bias"] = np.zeros_like(self.first), np.zeros_like(self.second), np.zeros_like(self.bias)
        g["embed"] = np.zeros_like(self.embed)
        for begin in np.unique(piece):
            if len(self.pieces(b)) > 1:
                parts = self.chunks(b[begin : begin + PIECE])
            self.backward(g, parts, np.flatnonzero(piece == begin), at, dh)
        return g

    def backward(self, g: dict[str, np.ndarray], parts, units: np.ndarray, at: np.ndarray, dh: np.ndarray) -> None:
        """Adds the gradients through one piece's chunks ``at`` to ``g``, for the hidden units given."""
        padded, x, z, means, size = parts
        g["hidden"][:, units] = means[at[units]].T * dh[units]
        dm = self.hidden.T[units] * dh[units, None]
        used, inverse = np.unique(at[units], return_inverse=True)
        per_chunk = np.zeros((len(used), FILTERS), dtype=np.float32)
        np.add.at(per_chunk, inverse, dm.astype(np.float32))
        for c, d in zip(used, per_chunk):
            a, e = c * HALF, min(len(z), (c + 2) * HALF)
            dz = (z[a:e] > 0) * (d / size[c])
            g["first"] += x[a:e].T @ dz
            g["second"] += x[a + 1 : e + 1].T @ dz
            g["bias"] += dz.sum(axis=0)
            dx = np.zeros((e - a + 1, x.shape[1]), dtype=np.float32)
            dx[:-1] += dz @ self.first.T
            dx[1:] += dz @ self.second.T
            np.add.at(g["embed"], padded[a * STRIDE : (e + 1) * STRIDE], dx.reshape(-1, EMBED + 1)[:, :EMBED])


def train(
    sample: list[tuple[str, int]], steps: int = 700, batch: int = 16, rate: float = 4e-3, seed: int = 7
) -> QualityNet:
    """Fits the network with about ``steps`` steps of Adam; deterministic.  Classes weigh alike; texts train
    whole.  A sample without both classes gives a constant score."""
    net = QualityNet.initial(seed)
    y = np.array([v for _, v in sample], dtype=np.float32)
    if len(y) == 0 or y.min() == y.max():
        rate_1 = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        net.out[:], net.out_bias[0] = 0, np.log(rate_1 / (1 - rate_1))
        return net
    data = [t.encode("utf-8", "surrogatepass") for t, _ in sample]
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    m = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    v = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    rng, t = np.random.default_rng(seed), 0
    epochs = -(-steps // -(-len(data) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            t += 1
            total = {n: np.zeros_like(m[n]) for n in net.NAMES}
            own = order[at : at + batch]
            for i in own:
                for n, g in net.gradients(data[i], y[i], weight[i]).items():
                    total[n] += g
            now = rate * (1 - t / (epochs * -(-len(data) // batch) + 1))
            for n in net.NAMES:
                g = total[n] / len(own) + 1e-5 * getattr(net, n)
                m[n] = 0.9 * m[n] + 0.1 * g
                v[n] = 0.99 * v[n] + 0.01 * g * g
                step = now * (m[n] / (1 - 0.9**t)) / (np.sqrt(v[n] / (1 - 0.99**t)) + 1e-8)
                setattr(net, n, (getattr(net, n) - step).astype(np.float32))
    return net


def fit(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most: int = 700,
    id_col: str = "doc_id", text_col: str = "text",
) -> QualityNet:
    """A network from at most ``2 * most`` labelled documents outside the held-out fold."""
    known = labels.where(~in_fold(id_col, folds, held_out))
    return train(labelled_sample(docs, known, "quality", most, id_col, text_col))


def scored(docs: DataFrame, net: QualityNet, column: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text (null: empty).  A column
    that is already named ``column`` is replaced."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text_col)

    def run(batches):
        own = shared.value
        for batch in batches:
            scores = [own.score(t) for _, texts in slices(batch, at) for t in texts]
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def kept(docs: DataFrame, model: QualityNet, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose whole text scores at least ``threshold``, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        own = shared.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(t) >= threshold for _, texts in slices(batch, at) for t in texts], pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)


def predictions(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, most: int = 700
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.  Repeated rows give
    repeated results; without usable labels all scores are the same; an empty table gives no
    rows.  A null text counts as empty.  Time is linear in a text's length.  Other columns,
    ``score`` or ``held_out`` among them, are not read."""
    found = scored(docs.select("doc_id", "text"), fit(docs, labels, folds, held_out, most))
    fold = F.coalesce(in_fold("doc_id", folds, held_out), F.lit(False))
    return found.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
