"""MinHash-style near-duplicates over SetSketch registers: exponentially spaced, truncated minima of marked Poisson points.

Every shingle is the seed of a Poisson process of rate REGISTERS * RATE whose points fall on registers at random. A register holds
the smallest point x that fell on it over all shingles of a set, as floor(1 - log_b(x)) cut to 16 bits; registers of a union are the
maxima of the registers of its parts. Equal registers of two sets are about as likely as their Jaccard similarity (a little more
likely, the base is close to 1), and independent of each other: BANDS bands of ROWS registers miss a pair of similarity 0.85 with a
probability below 1e-11. The numbers of larger, smaller and equal registers give the likelihood of each similarity, the sizes being
known; a proposal is dropped where the likelihood of its best similarity is e^25 times that of the one asked for. What is left
is decided on full shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import similar

BANDS = 43
ROWS = 5
REGISTERS = BANDS * ROWS
BASE = 1.01
RATE = 20.0
SHINGLE = 3
SIMILARITY = 0.85
#: Logarithm of the likelihood ratio beyond which a proposal is dropped.
MARGIN = 25.0
#: Similarities at which the likelihood is worked out.
GRID = np.round(np.arange(0, 1.0001, 0.01), 2)
#: Shingles whose points are drawn at once.
AT_ONCE = 1 << 17


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minima(hashes: np.ndarray, sets: np.ndarray, sizes: np.ndarray, registers: int = REGISTERS, rate: float = RATE) -> np.ndarray:
    """(number of sets, registers): the smallest point of each register. ``hashes`` holds all shingles, ``sets`` the set of each.

    Only points below a limit are drawn, at which a register is hit e^-3 times the registers on average not at all; sets with a register
    left get twice the limit. What a register holds does not depend on the limit.
    """
    found = np.full((len(sizes), registers), np.inf)
    limit = (np.log(registers) + 3) / (rate * np.maximum(sizes, 1))
    todo = np.arange(len(hashes))
    while len(todo):
        flat, seeds, owners = found.reshape(-1), hashes[todo], sets[todo]
        at, step = np.zeros(len(todo)), 0
        while len(seeds):
            step += 1
            drawn = _mixed(seeds + np.uint64((step * 0x9E3779B97F4A7C15) & (1 << 64) - 1))
            at = at - np.log(((drawn >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / (registers * rate)
            near = np.flatnonzero(at < limit[owners])
            at, seeds, owners, drawn = at[near], seeds[near], owners[near], drawn[near]
            which = (_mixed(drawn) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(flat, owners * registers + which, at)
        open_ = ~np.isfinite(found).all(axis=1) & (sizes > 0)
        limit = limit * 2
        todo = np.flatnonzero(open_[sets])
    return found


def registers_of(found: np.ndarray, base: float = BASE) -> np.ndarray:
    """floor(1 - log_base(x)) of the smallest points, cut to 16 bits."""
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(found) / np.log(base)), 0, 65535).astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set of shingle hashes; an empty set has zeros."""
    out, start = np.zeros((len(sets), REGISTERS), np.uint16), 0
    sizes = np.array([len(s) for s in sets], np.int64)
    while start < len(sets):
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), AT_ONCE)))
        own = sizes[start:stop]
        if own.sum():
            out[start:stop] = registers_of(minima(np.concatenate(sets[start:stop]), np.repeat(np.arange(len(own)), own), own))
        start = stop
    out[sizes == 0] = 0
    return out


def band_hashes(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(rows, bands): one hash for each band of registers."""
    parts = registers.reshape(len(registers), bands, -1).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(parts.shape[2]):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return total.view(np.int64)


def log_likelihood(larger: np.ndarray, smaller: np.ndarray, n: np.ndarray, m: np.ndarray, j: np.ndarray, registers: int = REGISTERS, base: float = BASE) -> np.ndarray:
    """Of the similarities ``j`` (columns) for sets of n and m shingles (rows), given how many registers of the first are larger and smaller."""
    u, v = (n / (n + m))[:, None], (m / (n + m))[:, None]
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)
    more, less = chance(u - v * j), chance(v - u * j)
    d, e = larger[:, None], smaller[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        term = lambda count, p: np.where(count == 0, 0.0, count * np.log(np.maximum(p, 0)))
        total = term(d, more) + term(e, less) + term(registers - d - e, 1 - more - less)
    # a set is no larger than the union: similarities above the ratio of sizes are impossible
    return np.where(j <= np.minimum(n, m)[:, None] / np.maximum(n, m)[:, None] + 1e-9, total, -np.inf)


def may_reach(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float = SIMILARITY, margin: float = MARGIN) -> np.ndarray:
    """Whether the registers leave it possible that the sets are so similar. Sizes that exclude it do so for sure."""
    larger, smaller = (x > y).sum(axis=1), (x < y).sum(axis=1)
    by = log_likelihood(larger, smaller, n.astype(float), m.astype(float), np.append(GRID, similarity)[None, :])
    best, enough = by.max(axis=1), by[:, np.append(GRID, similarity) >= similarity - 1e-9].max(axis=1)
    possible = np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6
    # a margin of likelihood, not a cut at the estimate; a similarity of 1 next to unequal registers is -inf on the grid only
    return possible & (best - np.maximum(enough, -1e300) <= margin)


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The similarity of the greatest likelihood, to two digits."""
    larger, smaller = (x > y).sum(axis=1), (x < y).sum(axis=1)
    return GRID[log_likelihood(larger, smaller, n.astype(float), m.astype(float), GRID[None, :]).argmax(axis=1)]


def pruned(links: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """The links that sizes, parities and registers leave possible. ``own``: (key, n, print, registers), one row for each key.

    Sizes and parities are exact bounds and come first: of near copies just below the similarity, registers let most through.
    """
    side = lambda end, *columns: own.select(F.col("key").alias(end), *[F.col(c).alias(name) for c, name in columns])
    sized = links.join(side("a", ("n", "n"), ("print", "p")), "a").join(side("b", ("n", "m"), ("print", "q")), "b").where(F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-6)
    sizes = lambda batch: (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m"))

    def bounded(batches):
        for batch in batches:
            prints = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, similar.BITS // 8)  # noqa: B023, E731
            near = similar.may_be_similar(*sizes(batch), prints("p") ^ prints("q"), similarity)
            yield batch.select(["a", "b", "n", "m"]).filter(pa.array(near, pa.bool_()))

    near = C.map_arrow(sized.select("a", "b", "n", "m", "p", "q"), bounded, "a long, b long, n long, m long")
    both = near.join(side("a", ("registers", "x")), "a").join(side("b", ("registers", "y")), "b")

    def run(batches):
        for batch in batches:
            matrix = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)  # noqa: B023, E731
            good = may_reach(matrix("x"), matrix("y"), *sizes(batch), similarity) if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return C.map_arrow(both.select("a", "b", "n", "m", "x", "y"), run, "a long, b long")


def bands_of(reps: DataFrame) -> DataFrame:
    """(key, registers) -> (hash, key), one row for each band."""

    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            keys = np.repeat(batch.column("key").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_hashes(x).reshape(-1)), pa.array(keys)], names=["hash", "key"])

    return C.map_arrow(reps.select("key", "registers"), run, "hash long, key long")


def sketch_table(narrow: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(key, id, text) -> key, id, n (distinct shingles), digest of the set, print (parities) and registers, both as bytes."""

    def run(batches):
        import xxhash

        for batch in C.small_batches(batches, "text", 2 << 20):
            sets = [similar.shingle_hashes(t or "", k) for t in batch.column("text").to_pylist()]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([similar.parities(s) for s in sets], pa.binary())]
            columns.append(pa.array([r.tobytes() for r in sketches(sets)], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), *columns], names=["key", "id", "n", "digest", "print", "registers"])

    return C.map_arrow(narrow, run, "key long, id long, n long, digest binary, print binary, registers binary")


def sketch_components(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id (smallest doc_id reachable by links), kept.

    A null text is empty; documents without words have no shingles and no links. Documents with equal sets meet as one.
    Null ids are ignored in the choice of component_id: a component of null ids alone has none, and its documents are kept.
    Rows that repeat id and text each give a row.
    """
    key = F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    narrow = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made = C.materialize(sketch_table(narrow, k), "sketch-sets")
    full = made.where("n > 0")
    own = C.materialize(full.select("key", "n", "print", "registers").dropDuplicates(["key"]), "sketch-own")
    prune = lambda links: pruned(links, own, similarity)
    roots = similar.components_in_rounds(full, bands_of, None, own.select("key", "n", "print"), prune, narrow.select("key", "text"), k, similarity)
    members = C.join_small(made.select("key", "id"), roots.withColumnRenamed("v", "key"), "key", "inner", similar.BROADCAST_ROWS)
    least = C.materialize(members.groupBy("root").agg(F.min("id").alias("component")), "sketch-least")
    known = C.materialize(C.join_small(roots, least, "root", "inner", similar.BROADCAST_ROWS).select(F.col("v").alias("key"), "component", F.lit(True).alias("linked")), "sketch-components")
    out = C.join_small(made.select("key", "id", "n"), known, "key", "left", similar.BROADCAST_ROWS)
    component = F.when(F.col("linked"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
