"""Toxicity by a classifier chain: categories in turn, each linear model also fed the probabilities of those before it."""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .quality import fold

#: Chain order. All three are labels of the table: toxic texts, and those of them that its quality label marks as junk (0) and
#: as prose (1).
CATEGORIES = ("toxic", "toxic_junk", "toxic_prose")
#: Bounds of the fit: labelled rows (in the order of a seeded hash), and features kept for each category.
TOXIC_DOCS = 4000
OTHER_DOCS = 8000
FEATURES = 1500
MIN_DOCS = 3
FOLDS = 4
SEED = 42
THRESHOLD = 0.5
STEMS = (4, 5, 6)
TOKEN = re.compile(r"[^\W\d_]+")
CACHE = 400_000


@dataclass(frozen=True)
class Chain:
    """Features by name, and for each category a bias, a weight per feature and a weight per earlier category."""

    features: tuple[str, ...]
    bias: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]
    earlier: tuple[tuple[float, ...], ...]


def names_of(word: str) -> list[str]:
    """A word's features: itself and its stems (initial letters, marked with a star), which inflected forms share."""
    return [word, *[f"{word[:n]}*" for n in STEMS if len(word) >= n]]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, extra: np.ndarray, ridge: float = 0.1, steps: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Ridge logistic regression by accelerated gradient; ``extra`` columns are the earlier probabilities."""
    a = np.hstack([x, extra.astype(np.float32), np.ones((len(x), 1), np.float32)])
    norm = 0.25 * float((a * a).sum(axis=1).max()) * len(a) ** 0.5 + ridge
    w = v = np.zeros(a.shape[1], np.float32)
    for k in range(steps):
        g = a.T @ (_sigmoid(a @ v) - y).astype(np.float32) + ridge * np.append(v[:-1], 0).astype(np.float32)
        new = v - g / norm
        v, w = new + np.float32(k / (k + 3)) * (new - w), new
    n = x.shape[1]
    return float(w[-1]), w[:n], w[n:-1]


def select_features(rows: list[np.ndarray], y: np.ndarray, names: list[str]) -> np.ndarray:
    """Ids of the FEATURES names whose log odds by label are the surest, among those in MIN_DOCS texts of label 1 at least; ties by name."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return np.zeros(0, np.int64)
    p = np.bincount(np.concatenate([np.zeros(0, np.int64), *[r for r, one in zip(rows, y, strict=True) if one]]), minlength=len(names))
    q = np.bincount(np.concatenate([np.zeros(0, np.int64), *[r for r, one in zip(rows, y, strict=True) if not one]]), minlength=len(names))
    seen = np.flatnonzero(p >= MIN_DOCS)
    p, q = p[seen], q[seen]
    odds = np.log((p + 0.5) / (n1 - p + 0.5)) - np.log((q + 0.5) / (n0 - q + 0.5))
    sure = np.abs(odds) / np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
    order = sorted(range(len(seen)), key=lambda i: (-sure[i], names[seen[i]]))
    return np.sort(seen[order[:FEATURES]])


def _matrix(rows: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    x = np.zeros((len(rows), len(features)), np.float32)
    for i, r in enumerate(rows):
        x[i, np.searchsorted(features, r[np.isin(r, features, assume_unique=True)])] = 1
    return x


def fit_chain(rows: list[np.ndarray], targets: np.ndarray, names: list[str]) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
    """For each category: bias, feature ids, their weights, and weights of the earlier categories.

    A later model is trained on what earlier ones predict for rows they were not fitted on: for every fold the features are
    selected and the model fitted on the other folds alone.
    """
    part = np.arange(len(rows)) % FOLDS
    held = np.zeros((len(rows), 0))
    models = []
    for c in range(targets.shape[1]):
        y = targets[:, c]
        out = np.zeros(len(rows))
        if c + 1 < targets.shape[1]:  # nothing follows the last category
            for f in range(FOLDS):
                train, rest = np.flatnonzero(part != f), np.flatnonzero(part == f)
                own = select_features([rows[i] for i in train], y[train], names)
                b, w, e = _fit(_matrix([rows[i] for i in train], own), y[train], held[train])
                out[rest] = _sigmoid(_matrix([rows[i] for i in rest], own) @ w + held[rest] @ e + b)
        own = select_features(rows, y, names)
        b, w, e = _fit(_matrix(rows, own), y, held)
        models.append((b, own, w, e))
        held = np.column_stack([held, out])
    return models


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", quality_col: str = "quality") -> Chain:
    """Fit on labelled rows whose id's crc32 modulo 5 isn't 0, at most TOXIC_DOCS and OTHER_DOCS of them, also where ids repeat.

    Features are words and stems of at least MIN_DOCS of a category's texts. Workers reduce each sampled text to its set of
    words; only these sets of a bounded number of texts reach the driver. A null quality is neither junk nor prose.
    Without rows of both labels every probability is the share of toxic rows (0 without any).
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"), F.coalesce(F.col(quality_col).cast("int"), F.lit(-1)).alias("q")).where(F.col("y").isin(0, 1)).where(fold(F.col("id")) != 0)
    order = F.xxhash64(F.lit(SEED), F.col("id"))
    limits = {1: TOXIC_DOCS, 0: OTHER_DOCS}
    chosen = known.where("y = 1").orderBy(order, "id", "q").limit(TOXIC_DOCS).unionByName(known.where("y = 0").orderBy(order, "id", "q").limit(OTHER_DOCS))
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def words(batches):
        for batch in C.small_batches(batches, "text"):
            found = [sorted(set(TOKEN.findall(t.lower()))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "y", "q")], pa.array(found, pa.list_(pa.string()))], names=["id", "y", "q", "words"])

    sampled = text.join(F.broadcast(chosen), "id").select(F.col("id").cast("long").alias("id"), "y", "q", "text")  # a bounded number of labels
    sampled = C.materialize(C.map_arrow(sampled, words, "id long, y int, q int, words array<string>"), "toxicity-words")
    y, q, sets = [], [], []
    for label in (1, 0):
        # a repeated id has multiplied its rows: the bound holds for what is gathered
        for r in sampled.where(F.col("y") == label).orderBy(order, "id", "q", F.xxhash64("words")).limit(limits[label]).toLocalIterator():
            y.append(r["y"])
            q.append(r["q"])
            sets.append([sys.intern(w) for w in r["words"]])  # one string for each distinct word
    labels_found = np.array(y, dtype=np.float64)
    if not len(y) or labels_found.min() == labels_found.max():
        b = -30.0 if not len(y) or labels_found.max() == 0 else 30.0
        return Chain((), (b,) * len(CATEGORIES), ((),) * len(CATEGORIES), tuple((0.0,) * k for k in range(len(CATEGORIES))))
    mixed = np.random.default_rng(SEED).permutation(len(y))  # every fold gets rows of both labels
    labels_found, junk, sets = labels_found[mixed], np.array(q)[mixed], [sets[i] for i in mixed]
    counts: Counter = Counter()
    for own, label in zip(sets, labels_found, strict=True):
        if label:
            counts.update({n for w in own for n in names_of(w)})
    names = sorted(n for n, c in counts.items() if c >= MIN_DOCS)
    at = {name: i for i, name in enumerate(names)}
    rows = [np.array(sorted({at[n] for w in s for n in names_of(w) if n in at}), np.int64) for s in sets]
    targets = np.column_stack([labels_found, labels_found * (junk == 0), labels_found * (junk == 1)])
    models = fit_chain(rows, targets, names)
    used = np.unique(np.concatenate([own for _, own, _, _ in models]))
    weights = np.zeros((len(models), len(used)))
    for c, (_, own, w, _) in enumerate(models):
        weights[c, np.searchsorted(used, own)] = w
    return Chain(tuple(names[i] for i in used), tuple(b for b, _, _, _ in models), tuple(tuple(map(float, w)) for w in weights), tuple(tuple(map(float, e)) for _, _, _, e in models))


@lru_cache(maxsize=2)
def _scorer(chain: Chain):
    at = {name: i for i, name in enumerate(chain.features)}
    weights = np.array(chain.weights, dtype=np.float64).reshape(len(CATEGORIES), -1)
    known: dict[str, tuple[int, ...]] = {}

    def score(text: str) -> list[float]:
        found: set[int] = set()
        for w in set(TOKEN.findall(text.lower())):
            own = known.get(w)
            if own is None:
                if len(known) >= CACHE:
                    known.clear()
                own = known[w] = tuple(at[n] for n in names_of(w) if n in at)
            found.update(own)
        z = weights[:, sorted(found)].sum(axis=1) if found else np.zeros(len(CATEGORIES))
        out: list[float] = []
        for c in range(len(CATEGORIES)):
            out.append(float(_sigmoid(z[c] + chain.bias[c] + np.dot(chain.earlier[c], out))))
        return out

    return score


def toxicity(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, p_<category> for each category of the chain, toxic (p_toxic >= threshold).

    The whole text counts; a null or empty one has no features and gets the models' biases. One pass, nothing shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        score = _scorer(shared.value)
        for batch in C.small_batches(batches, "text"):
            found = [score(t or "") for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[c] for f in found], pa.float64()) for c in range(len(CATEGORIES))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *[f"p_{c}" for c in CATEGORIES]])

    rows = C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES), "toxicity._scorer")
    return rows.withColumn("held_out", fold(F.col("doc_id")) == 0).withColumn("toxic", F.col("p_toxic") >= threshold)
