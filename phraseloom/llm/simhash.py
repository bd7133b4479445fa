"""SimHash near-duplicates: every pair of fingerprints at most two bits apart, found by pigeonring filtering.

A 64-bit fingerprint is a ring of eight one-byte segments. If two fingerprints differ in at most two bits, some chain of
consecutive segments has cumulative differences within its share of the two bits all along: 0 over one to three segments, at
most 1 over four to seven (the pigeonring principle; the plain pigeonhole asks for the first segment only). Over a chain of
seven segments at most one differs, and the eighth is free: 28 choices of two free segments, each giving a key of 48 fixed bits.
Only fingerprints with a common key are compared. The 16 free bits bound a key's group by 65,536 distinct fingerprints,
whatever the data: copies are one fingerprint, and no group can grow with the input.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
SEGMENTS = 8
#: Groups of a key up to this size are compared pair by pair; larger ones through sorted masks, in time about linear in their size.
SMALL_GROUP = 8
BROADCAST_ROWS = 500_000
BUDGETS = tuple(length * RADIUS // SEGMENTS for length in range(1, SEGMENTS))


def hash_shingles(text: str, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each k-word shingle, repeats included; the whole sequence if it is shorter; nothing for no words."""
    import xxhash

    words = text.encode().lower().split()  # bytes: lowers A-Z only and splits at blanks, tabs and line breaks only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = zip(*[words[i:] for i in range(k)], strict=False)
    return np.array([digest(b" ".join(s), SEED) for s in joined], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; no hashes: 0."""
    ones, n = np.zeros(64, dtype=np.int64), len(hashes)
    for at in range(0, n, 1 << 14):
        part = np.unpackbits(hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. A null text is empty; texts without words have fingerprint 0."""

    def run(batches):
        for batch in C.small_batches(batches, "text"):
            fps = np.array([fingerprint(hash_shingles(t or "", k)) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, fp long")


def chain_within_budget(diff: np.ndarray) -> np.ndarray:
    """The pigeonring test on XORs of fingerprints: does some chain start stay within every cumulative budget?"""
    per = np.bitwise_count(diff.astype("<u8").view(np.uint8).reshape(-1, SEGMENTS)).astype(np.int16)
    ok = np.zeros(len(per), dtype=bool)
    for start in range(SEGMENTS):
        total, fine = np.zeros(len(per), dtype=np.int16), np.ones(len(per), dtype=bool)
        for length, budget in enumerate(BUDGETS):
            total = total + per[:, (start + length) % SEGMENTS]
            fine &= total <= budget
        ok |= fine
    return ok


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs are links: the chain test first, the full Hamming distance for what passes."""
    diff = a ^ b
    found = np.flatnonzero(chain_within_budget(diff))
    return found[np.bitwise_count(diff[found]) <= RADIUS]


def _link_large(fps: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of a group whose members differ in the ``free`` 16 bits only.

    Two members are within two bits exactly if they agree after some pair of free bits is masked. Sorting the group under each
    of the 120 masks brings such members together; neighbours under a mask are the candidates, which pass the chain test and
    the full distance like all others. Members that agree under one mask are linked in a row, so that these links
    span what all pairs would; of them one for each step that joins two parts is kept.
    """
    bits = [1 << i for i in range(64) if free >> i & 1]
    pairs = []
    for x, y in combinations(bits, 2):
        masked = fps & np.uint64(~(x | y) & (1 << 64) - 1)
        order = np.argsort(masked, kind="stable")
        same = np.flatnonzero(masked[order][1:] == masked[order][:-1])
        a, b = order[same], order[same + 1]
        near = _near(fps[a], fps[b])
        pairs.append(np.minimum(a, b)[near] * len(fps) + np.maximum(a, b)[near])
    pairs = np.unique(np.concatenate(pairs))
    a, b = pairs // len(fps), pairs % len(fps)
    labels, left, right = np.arange(len(fps)), [], []
    while True:
        x, y = labels[a], labels[b]
        open_ = np.flatnonzero(x != y)
        if not len(open_):
            break
        # every part but the smaller one of a pair hooks to one smaller part; the pair that did it is kept
        high, low = np.maximum(x[open_], y[open_]), np.minimum(x[open_], y[open_])
        order = np.lexsort((low, high))
        first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
        left.append(a[open_[first]])
        right.append(b[open_[first]])
        parent = np.arange(len(fps))
        parent[high[first]] = low[first]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        labels = parent[labels]
    if not left:
        return fps[:0], fps[:0]
    return fps[np.concatenate(left)], fps[np.concatenate(right)]


def _links_of_groups(which: np.ndarray, key: np.ndarray, fps: np.ndarray, masks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal (which, key)."""
    edge = np.concatenate([[True], (np.diff(key) != 0) | (np.diff(which) != 0)])
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(key)))
    run = np.cumsum(edge) - 1
    small = size[run] <= SMALL_GROUP
    left, right = [], []
    for k in range(1, min(SMALL_GROUP, int(size.max(initial=1)))):
        at = np.flatnonzero((run[k:] == run[:-k]) & small[k:])
        near = at[_near(fps[at], fps[at + k])]
        left.append(fps[near])
        right.append(fps[near + k])
    for f, n in zip(first[size > SMALL_GROUP], size[size > SMALL_GROUP], strict=True):
        a, b = _link_large(fps[f : f + n], masks[which[f]])
        left.append(a)
        right.append(b)
    return np.concatenate(left) if left else fps[:0], np.concatenate(right) if right else fps[:0]


def near_links(distinct: DataFrame) -> DataFrame:
    """(fp) distinct -> (a, b): links whose components are those of all pairs at most RADIUS bits apart."""
    segment = [0xFF << 8 * i for i in range(SEGMENTS)]
    masks = [segment[x] | segment[y] for x, y in combinations(range(SEGMENTS), 2)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(signed(~m & (1 << 64) - 1))) for m in masks])
    rows = distinct.select("fp", F.posexplode(keys).alias("which", "key"))

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        kept = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column("which").to_numpy(zero_copy_only=False), batch.column("key").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)]
                kept = [np.concatenate(x) for x in zip(kept, new, strict=True)]
                if not len(kept[0]):
                    continue
                changes = np.flatnonzero((np.diff(kept[1]) != 0) | (np.diff(kept[0]) != 0))
                stop = int(changes[-1]) + 1 if len(changes) else 0  # the last group may go on in the next batch
            else:
                stop = len(kept[0])
            if stop:
                a, b = _links_of_groups(*[x[:stop] for x in kept], masks)
                kept = [x[stop:] for x in kept]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    parts = rows.repartition("which", "key").sortWithinPartitions("which", "key")
    return C.map_arrow(parts.select("which", "key", "fp"), run, "a long, b long")


def _with_end(batches):
    yield from batches
    yield None


def _component_of(nodes: DataFrame) -> DataFrame:
    """nodes (fp, least, n) -> (fp, component) for every fingerprint that has a link or several documents; least of each."""
    nodes = C.materialize(nodes, "simhash-nodes")
    roots = C.materialize(connected_components(near_links(nodes.select("fp"))), "simhash-roots")
    linked = C.join_small(nodes, roots.withColumnRenamed("v", "fp"), "fp", "inner", BROADCAST_ROWS)
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    ids = roots.join(least, "root").select(F.col("v").alias("fp"), "component")
    alone = nodes.where("n > 1").select("fp", F.col("least").alias("component")).join(roots.select(F.col("v").alias("fp")), "fp", "left_anti")
    return C.materialize(ids.unionByName(alone), "simhash-components")


def simhash_components(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Fingerprints link at RADIUS or fewer differing bits. Copies collapse into one distinct fingerprint before anything is
    compared; components are formed over distinct fingerprints only. Null ids are ignored in the choice of
    component_id (a component of null ids alone has none).
    """
    fps = C.materialize(fingerprints(docs, k, id_col, text_col), "simhash")
    known = _component_of(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    out = C.join_small(fps, known, "fp", "left", BROADCAST_ROWS)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component left, the one with the smallest id (nulls last); columns unchanged.

    Rows that repeat both id and text are one document and stay or go together. Only the rows to drop are joined to the texts.
    """
    held, back, (own_id, text) = C.renamed(docs, id_col, text_col)
    keyed = held.withColumn("__key", F.xxhash64(F.col(own_id).cast("string"), F.coalesce(F.col(text), F.lit(""))))
    own = F.struct(F.coalesce(F.col("id"), F.lit((1 << 63) - 1)).alias("id"), F.col("doc_id").alias("key"))
    # the key travels as the id of the fingerprint pass, the id itself beside it
    fps = fingerprints(keyed.select(F.col("__key").alias("doc_id"), F.col(text).alias("text")), k)
    ids = keyed.select(F.col("__key").alias("doc_id"), F.col(own_id).cast("long").alias("id")).distinct()
    fps = C.materialize(fps.distinct().join(ids, "doc_id").select("fp", own.alias("own")), "simhash")
    known = _component_of(fps.groupBy("fp").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("n")))
    rows = C.join_small(fps, known, "fp", "inner", BROADCAST_ROWS)
    gone = C.materialize(rows.where(F.col("own") != F.col("component")).select(F.col("own.key").alias("__key")), "simhash-gone")
    return back(C.join_small(keyed, gone, "__key", "left_anti", BROADCAST_ROWS))
