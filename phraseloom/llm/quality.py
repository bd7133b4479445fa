"""Quality classifier by compression: two zstandard dictionaries, one of good and one of bad text, judge every chunk."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Bytes that are compressed at once: small enough for the dictionaries to matter in long texts as in short ones.
CHUNK = 1024
DICT_BYTES = 1 << 17
LEVEL = 1
#: Bounds of what the classifier is fitted on, in the order of seeded hashes: labelled texts of each label, chunks out of all
#: chunks of these texts for a dictionary, and labelled texts for the calibration.
DICT_DOCS = 4000
DICT_CHUNKS = 3000
CALIBRATION_DOCS = 12_000
SEED = 42
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """Both dictionaries and the logistic calibration of the features (see chunk_features)."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids are in fold 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5, F.lit(1))


def _dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their content serves as it is
        return b"".join(samples)[-DICT_BYTES:]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes):
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


def chunk_features(text: str, good: bytes, bad: bytes) -> tuple[float, float, float, float]:
    """1, the normalised difference of the compressed sizes (bad - good over their sum), and how far the text compresses.

    The last two (log ratio of the smaller size to the raw one, and its square) tell repeated junk, which both dictionaries
    compress alike. An empty text has difference 0 and log ratio 0.
    """
    raw = text.encode()
    if not raw:
        return 1.0, 0.0, 0.0, 0.0
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    g = b = 0
    for at in range(0, len(raw), CHUNK):
        part = raw[at : at + CHUNK]
        g += len(by_good(part))
        b += len(by_bad(part))
    ratio = np.log(min(g, b) / len(raw))
    return 1.0, 100 * (b - g) / (b + g), float(ratio), float(ratio * ratio)


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method on standardised features, folded back."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[0] = 0.0, 1.0
    scale[scale == 0] = 1.0
    z = (x - mean) / scale
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    out = w / scale
    out[0] = w[0] - float((w[1:] * mean[1:] / scale[1:]).sum())
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on labelled rows whose fold isn't 0: dictionaries on folds 1-3, calibration on fold 4.

    At most DICT_DOCS texts of each label and CALIBRATION_DOCS texts are used, chosen by a seeded hash of the id. Of all chunks of
    a label's texts, however long, DICT_CHUNKS are drawn in a seeded order, one of each text in turn. Only these bounded samples reach the driver, also
    where ids repeat in either table. Null labels are left out. Without rows of both labels the score is the share of label 1 (0.5 without any).
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1)).withColumn("fold", fold(F.col("id"))).where("fold <> 0")
    order = F.xxhash64(F.lit(SEED), F.col("id"))
    parts = [known.where((F.col("fold") < 4) & (F.col("y") == y)).orderBy(order, "id").limit(DICT_DOCS) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / CHUNK) - 1, F.lit(0)).cast("int"))).alias("at")
    # at most 2 * DICT_DOCS rows are broadcast
    chunks = text.join(F.broadcast(chosen), "id").select("id", "y", "text", at).select("id", "y", "at", F.substring(F.col("text"), F.col("at") * CHUNK + 1, F.lit(CHUNK)).alias("piece")).where("piece <> ''")
    samples: dict[int, list[bytes]] = {}
    for y in (0, 1):
        own = chunks.where(F.col("y") == y).withColumn("place", F.xxhash64(F.lit(SEED), "id", "at"))
        turn = F.row_number().over(Window.partitionBy("id").orderBy("place", "at", "piece"))
        drawn = own.withColumn("turn", turn).orderBy("turn", "place", "id", "at", "piece").limit(DICT_CHUNKS).select("id", "at", "piece").collect()
        samples[y] = [r["piece"].encode() for r in sorted(drawn, key=lambda r: (r["id"] is None, r["id"], r["at"], r["piece"]))]
    tuning = known.where("fold = 4").orderBy(order, "id").limit(CALIBRATION_DOCS)
    if not samples[0] or not samples[1]:
        share = known.agg(F.avg("y")).first()[0]
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    good, bad = _dictionary(samples[1]), _dictionary(samples[0])
    scored = text.join(F.broadcast(tuning), "id").select(F.col("y"), "text")
    got = C.map_arrow(scored, _scorer(good, bad, "y"), "y int, a double, b double, c double, d double", "quality._compressor")
    got = got.orderBy(F.xxhash64(F.lit(SEED), "b", "c"), "y", "b", "c").limit(CALIBRATION_DOCS).orderBy("y", "b", "c").collect()
    y = np.array([r["y"] for r in got], dtype=float)
    if len(got) < 8 or y.min() == y.max():
        return Model(good, bad, (0.0, 1.0, 0.0, 0.0))
    x = np.array([[r["a"], r["b"], r["c"], r["d"]] for r in got])
    return Model(good, bad, tuple(_fit_logistic(x, y)))


def _scorer(good: bytes, bad: bytes, key: str):
    def run(batches):
        for batch in C.small_batches(batches, "text"):
            found = [chunk_features(t or "", good, bad) if good else (1.0, 0.0, 0.0, 0.0) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], names=[key, "a", "b", "c", "d"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out (fold 0), score (0 to 1, higher: label 1 likelier), predicted (score >= 0.3)."""
    rows = C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), _scorer(model.good, model.bad, "doc_id"), "doc_id long, a double, b double, c double, d double", "quality._compressor")
    z = sum((F.lit(float(w)) * F.col(c) for w, c in zip(model.weights[1:], "bcd", strict=True)), F.lit(float(model.weights[0])))
    value = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), value.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts whose score is below ``threshold``; columns unchanged, nothing joined or shuffled."""
    w = model.weights
    good, bad = model.good, model.bad

    def run(batches):
        cut = np.log(threshold / (1 - threshold))
        for batch in C.small_batches(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            z = [np.dot(w, chunk_features(t or "", good, bad) if good else (1.0, 0.0, 0.0, 0.0)) for t in texts]
            yield batch.filter(pa.array([bool(v >= cut) for v in z], pa.bool_()))

    return C.map_arrow(docs, run, docs.schema, "quality._compressor")
