"""Toxicity: a sparse linear classifier with counterfactual regularisation.

A text's score is a logistic function of a sum over its distinct words; a word counts
by its own weight and those of its character n-grams.  Only features whose presence
differs clearly between the classes get a weight.  In training, identity terms
in labelled sentences are swapped for other terms of their group, and set into
sentences that have none; every change of score between a sentence and its
counterfactual is penalised.  So naming a group neither raises nor lowers a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm._common import slices, tidied
from spindle.llm.training import in_fold, labelled_sample

#: Identity terms in groups whose members may stand for each other (fixed values).
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("mothers", "fathers"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "indigenous"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"), ("disabled", "deaf", "blind"), ("old", "young"),
    ("americans", "mexicans", "chinese", "germans", "africans", "indians"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("schwarze", "weiße"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"), ("immigrés", "étrangers"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"), ("inmigrantes", "extranjeros"),
)
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
GRAMS = (4, 5)


def word_features(word: str) -> set[str]:
    """A word with its ends marked, and its n-grams."""
    marked = f"^{word}$"
    found = {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    found.add(marked)
    return found


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


class Features:
    """Numbers for the features of a bounded sample."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.words: dict[str, np.ndarray] = {}

    def of_word(self, w: str) -> np.ndarray:
        found = self.words.get(w)
        if found is None:
            number = self.number
            own = [number.setdefault(g, len(number)) for g in sorted(word_features(w))]
            self.words[w] = found = np.array(own, dtype=np.int32)
        return found

    def of_bag(self, bag: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and summed weights of a bag of words."""
        own = [self.of_word(w) for w in bag]
        if not own:
            return np.zeros(0, np.int32), np.zeros(0)
        index, back = np.unique(np.concatenate(own), return_inverse=True)
        return index, np.bincount(back, np.repeat(list(bag.values()), [len(o) for o in own]))


@dataclass
class Rows:
    """Sparse rows in compressed form."""

    index: np.ndarray
    value: np.ndarray
    size: np.ndarray
    width: int
    owner: np.ndarray = field(init=False)

    def __post_init__(self):
        self.owner = np.repeat(np.arange(len(self.size)), self.size)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, w[self.index] * self.value, len(self.size))

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, r[self.owner] * self.value, self.width)


def rows_of(features: Features, bags: list[dict[str, float]], place: np.ndarray, scale: np.ndarray) -> Rows:
    """Rows of the kept features (``place`` >= 0), each times its scale."""
    index, value, size = [np.zeros(0, np.int64)], [np.zeros(0)], []
    for bag in bags:
        i, v = features.of_bag(bag)
        at = np.where(i < len(place), place[np.minimum(i, len(place) - 1)], -1)
        index.append(at[at >= 0])
        value.append(v[at >= 0] * scale[at[at >= 0]])
        size.append(len(index[-1]))
    return Rows(np.concatenate(index), np.concatenate(value), np.array(size, dtype=np.int64), len(scale))


def counterfactuals(texts: list[str]) -> list[tuple[dict[str, float], float]]:
    """Differences (as word bags) between labelled sentences and their counterfactuals, each
    with its share of all of them.

    Sentences that name a group get the other members in its place.  So that every term is
    covered, every term is also set into the sentences without any; as a sentence's other
    words cancel, that is one difference a term, as often as there are such sentences, and
    counts as much as all swaps together."""
    of = {t: g for g in IDENTITY_GROUPS for t in g}
    swaps: Counter[tuple[str, str]] = Counter()
    plain = 0
    for text in texts:
        for sentence in SENTENCE.findall(text):
            words = words_of(sentence)
            named = sorted(words & of.keys())
            plain += not named and bool(words)
            swaps.update((w, other) for w in named for other in of[w] if other not in words)
    total, kinds = sum(swaps.values()), bool(swaps) + bool(plain)
    out = [({w: 1.0, other: -1.0}, n / total / kinds) for (w, other), n in sorted(swaps.items())]
    return out + [({t: 1.0}, 1 / len(of) / kinds) for t in of if plain]


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float
    cache_words: int = 200_000
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, w: str) -> float:
        weights, marked = self.weights, f"^{w}$"
        n = len(marked)
        found = [g for k in GRAMS for i in range(n - k + 1) if (g := marked[i : i + k]) in weights]
        if marked in weights:
            found.append(marked)
        return sum(weights[g] for g in sorted(set(found))) if found else 0.0

    def logit(self, text: str) -> float:
        cache = self.cache
        words = words_of(text)
        if len(cache) + len(words) > self.cache_words:
            cache.clear()
        found = []
        for w in words:
            s = cache.get(w)
            if s is None:
                cache[w] = s = self.word(w)
            if s:
                found.append(s)
        return self.bias + math.fsum(found)

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.logit(text)))))

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "cache_words": self.cache_words, "cache": {}}


def separation(features: Features, bags: list[dict[str, float]], y: np.ndarray) -> np.ndarray:
    """Of each feature, by how many standard errors its share of documents differs."""
    counts = []
    for label in (0, 1):
        total = np.zeros(0)
        for bag in (b for b, v in zip(bags, y) if v == label):
            i, _ = features.of_bag(bag)
            if len(i) and i[-1] >= len(total):
                total = np.concatenate((total, np.zeros(max(len(features.number), i[-1] + 1) - len(total))))
            total[i] += 1
        counts.append(total)
    n0, n1, size = (y == 0).sum(), (y == 1).sum(), len(features.number)
    c0, c1 = (np.concatenate((c, np.zeros(size - len(c)))) for c in counts)
    share = (c0 + c1 + 1) / (len(y) + 2)
    return (c1 / n1 - c0 / n0) / np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))


def train(
    sample: list[tuple[str, int]],
    clear: float = 3.0,
    l1: float = 2e-4,
    counterfactual: float = 1.0,
    rounds: int = 400,
    prior: float = 0.4,
) -> ToxicityModel:
    """Fits the model by accelerated proximal gradient steps; deterministic.

    Features that separate the classes by less than ``clear`` standard errors get no
    weight; the others are scaled by how far they exceed it.  Classes are weighted so
    that toxic texts have the share ``prior``.  A sample without both classes gives a
    constant score."""
    texts, y = [t for t, _ in sample], np.array([v for _, v in sample], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        rate = np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99)
        return ToxicityModel({}, float(np.log(rate / (1 - rate))))
    features = Features()
    bags = [dict.fromkeys(sorted(words_of(t)), 1.0) for t in texts]
    z = separation(features, bags, y)
    kept = np.flatnonzero(np.abs(z) > clear)
    place = np.full(len(z), -1, dtype=np.int64)
    place[kept] = np.arange(len(kept))
    scale = np.minimum(np.abs(z[kept]) - clear, 10) / 10
    swaps = counterfactuals(texts)
    x, d = rows_of(features, bags, place, scale), rows_of(features, [b for b, _ in swaps], place, scale)
    weight = np.where(y == 1, prior / y.sum(), (1 - prior) / (1 - y).sum())
    pull = counterfactual * np.array([share for _, share in swaps])
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    v = np.ones(len(kept))
    curve = 1.0
    for _ in range(15):  # the largest curvature, by power iteration
        v = 0.25 * x.transposed_times(weight * x.times(v)) + d.transposed_times(pull * d.times(v))
        curve = float(np.linalg.norm(v)) or 1.0
        v /= curve
    step = 1 / (1.1 * curve + 0.25)
    wz, bz, t = w, b, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x.times(wz) + bz, -50, 50)))
        r = weight * (p - y)
        g = x.transposed_times(r) + d.transposed_times(pull * d.times(wz))
        nw = wz - step * g
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
        nb = bz - step * r.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wz, bz = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    names = list(features.number)
    own = w * scale
    return ToxicityModel({names[i]: float(v) for i, v in zip(kept, own) if v}, float(b))


def fit(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, most: int = 1500,
    id_col: str = "doc_id", text_col: str = "text",
) -> ToxicityModel:
    """A model from at most ``2 * most`` labelled documents outside the held-out fold;
    of labels only the rows of the other folds are read."""
    known = labels.where(~in_fold(id_col, folds, held_out))
    return train(labelled_sample(docs, known, "toxic", most, id_col, text_col))


def scored(docs: DataFrame, model: ToxicityModel, column: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text (null: empty).  A column
    that is already named ``column`` is replaced."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        own = shared.value
        for batch in batches:
            scores = [own.score(t) for _, texts in slices(batch, at) for t in texts]
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def kept(docs: DataFrame, model: ToxicityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose whole text scores below ``threshold``, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        own = shared.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(t) < threshold for _, texts in slices(batch, at) for t in texts], pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)


def predictions(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, threshold: float = 0.7, most: int = 1500
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.  Repeated rows give
    repeated results; without usable labels all scores are the same; an empty table gives no
    rows.  A null text counts as empty.  Time is linear in a text's length.  Other columns,
    ``score`` or ``held_out`` among them, are not read."""
    found = scored(docs.select("doc_id", "text"), fit(docs, labels, folds, held_out, most))
    fold = F.coalesce(in_fold("doc_id", folds, held_out), F.lit(False))
    return found.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
