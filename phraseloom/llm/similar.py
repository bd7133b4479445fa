"""Near copies by shingle similarity: SimHash and rare shingles propose pairs, parity fingerprints prune them, shingle sets decide.

Every pair of documents whose five-word shingles have a Jaccard similarity of 0.8 or more is joined, by one link or by a chain
of links. Two sets of similarity t share a shingle among the first n - ceil(t n) + 1 of each in any one order of all shingles
(the prefix filter), so that no pair is missed whatever the edits look like. The order is by frequency in a sample, then by
hash: what many documents share comes last, and the sample changes the cost and never the result.

Documents of equal sets stand behind one of them. The others are compared in two rounds. In the first, SimHash fingerprints of the
five-word shingles propose what the pigeonring filter of ``simhash`` links, and every document meets the first and the
previous one of each of its prefix shingles. In the second it meets all others of its prefix shingles that verified links do not
join to it already: this round alone loses no pair, the first one spares it the many pairs within large groups.

What is compared must pass exact bounds: that of the sizes, that of BITS parities (bit i is the parity of the number of
hashes that fall on it: two sets differ in no fewer shingles than their parities in bits), and that of as many parities as
the set has shingles, without which long texts would all pass.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import simhash
from .components import connected_components

BITS = 480
#: Differing bits that two sets of 300 shingles may have at similarity 0.8; other sizes have their own bound (see difference).
RADIUS = 67
SHINGLE = 5
SIMILARITY = 0.8
#: Rows of one shingle that are compared at once with so many others.
SMALL_GROUP = 48
AT_ONCE = 4096
#: Rows of one shingle beyond which it is cut into blocks that meet pairwise, in tasks of their own.
BLOCK_ROWS = 8192
#: Documents of the frequency sample (one in 16 between these bounds) and shingles that are known as frequent.
SAMPLE = (2048, 65_536)
FREQUENT = 200_000
#: Links of one document that are verified by one task.
LINKS_AT_ONCE = 256
BROADCAST_ROWS = 500_000


def shingle_hashes(text: str, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; of the whole sequence where it is shorter; nothing for no words."""
    return np.unique(simhash.hash_shingles(text, k))


def parities(hashes: np.ndarray) -> bytes:
    """Bit i is the parity of the number of hashes that fall on it."""
    return np.packbits(np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1).tobytes()


def wide_parities(hashes: np.ndarray) -> bytes:
    """The same in the power of two of bits that holds the number of hashes, 512 at least."""
    bits = 1 << max(9, (len(hashes) - 1).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two wide fingerprints differ; the longer one is folded to the length of the other."""
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        half = len(x) // 2
        x = (int.from_bytes(x[:half]) ^ int.from_bytes(x[half:])).to_bytes(half)
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


def difference(sizes: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The most shingles that two sets of this total size may differ in."""
    return np.floor(sizes * (1 - similarity) / (1 + similarity) + 1e-6)


def within_radius(diff: np.ndarray, radius: np.ndarray | int = RADIUS) -> np.ndarray:
    """XORs of fingerprints (rows of bytes) with at most ``radius`` bits."""
    return np.bitwise_count(diff).sum(axis=-1, dtype=np.int64) <= radius


def may_be_similar(n: np.ndarray, m: np.ndarray, diff: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m shingles can be so similar by their sizes and the XOR of their fingerprints."""
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6) & within_radius(diff, difference(n + m, similarity))


def prefix(hashes: np.ndarray, frequent: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first n - ceil(similarity n) + 1 of the sorted hashes, rare ones first."""
    n = len(hashes)
    if not n:
        return hashes
    width = n - math.ceil(similarity * n - 1e-6) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rank = np.where(frequent[at] == hashes, counts[at], 0)
        hashes = hashes[np.lexsort((hashes, rank))]
    return hashes[:width]


def frequent_shingles(narrow: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that several documents of a sample have, and in how many; at most FREQUENT."""
    rows = narrow.count()
    every = max(1, rows // min(max(rows // 16, SAMPLE[0]), SAMPLE[1]))

    def run(batches):
        for batch in C.small_batches(batches, "text"):
            found = [shingle_hashes(t or "", k) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], names=["hash"])

    sample = narrow.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("text")
    counted = C.map_arrow(sample, run, "hash long").groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = counted.orderBy(F.desc("n"), "hash").limit(FREQUENT).toArrow()
    hashes, counts = found.column("hash").to_numpy().astype(np.int64).view(np.uint64), found.column("n").to_numpy().astype(np.int64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def shared_shingles(rows: DataFrame) -> DataFrame:
    """(hash, key) -> (hash, key, first, before) of every hash of several keys: the first key of the hash and the one before."""

    def run(batches):
        held = None  # the last row so far: its hash and key, whether it begins a hash, the first key and the one before it

        def table(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hash", "key", "first", "before"])

        for batch in batches:
            if not batch.num_rows:
                continue
            h, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "key"))
            if held is None:
                start, first_key, before_key = True, key[0], key[0]
            else:
                h, key = np.concatenate([[held[0]], h]), np.concatenate([[held[1]], key])
                start, first_key, before_key = held[2:]
            same = h[1:] == h[:-1]
            new = np.concatenate([[start], ~same])
            at = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            first = key[at]
            if not start:
                first[at == 0] = first_key
            before = np.where(new, key, np.concatenate([[before_key], key[:-1]]))
            shared = np.flatnonzero(~new[:-1] | same)
            if len(shared):
                yield table(h[shared], key[shared], first[shared], before[shared])
            held = (h[-1], key[-1], new[-1], first[-1], before[-1])
        if held is not None and not held[2]:
            yield table(*[np.array([x]) for x in (held[0], held[1], held[3], held[4])])

    parts = rows.repartition("hash").sortWithinPartitions("hash", "key")
    return C.map_arrow(parts.select("hash", "key"), run, "hash long, key long, first long, before long")


def _pairs(keys: np.ndarray, n: np.ndarray, roots: np.ndarray, prints: np.ndarray, blocks: np.ndarray, similarity: float, small: int = SMALL_GROUP):
    """Pairs of rows of one shingle that have different roots and may be similar, in blocks; two blocks of rows meet each other only."""
    order = np.argsort(n, kind="stable")
    keys, n, roots, prints, blocks = keys[order], n[order], roots[order], prints[order], blocks[order]
    across = blocks.min() != blocks.max()
    for at in range(0, len(keys), small):
        stop = min(at + small, len(keys))
        end = int(np.searchsorted(n, n[stop - 1] / similarity + 1e-6, side="right"))  # larger sets can't be similar
        for low in range(at, end, AT_ONCE):
            high = min(low + AT_ONCE, end)
            meet = (roots[at:stop, None] != roots[None, low:high]) & (np.arange(at, stop)[:, None] < np.arange(low, high)[None, :])
            if across:
                meet &= blocks[at:stop, None] != blocks[None, low:high]
            i, j = np.nonzero(meet)
            i, j = i + at, j + low
            near = may_be_similar(n[i], n[j], prints[i] ^ prints[j], similarity)
            if near.any():
                yield keys[i[near]], keys[j[near]]


def open_pairs(rows: DataFrame, similarity: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(hash, key, n, root, print, rows) -> (a, b) distinct: keys of one hash with different roots that may be similar.

    A hash of more than ``block_rows`` rows is cut into blocks, and every two blocks are a group of their own: no task holds the whole.
    """
    small = SMALL_GROUP
    cut = F.ceil(F.col("rows") / block_rows).cast("int")
    block = F.pmod(F.xxhash64("key"), cut).cast("int")
    # the pairs of blocks that a row belongs to: with every block, and with its own only where there is no other
    others = F.when(cut == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), cut - 1))
    spread = rows.select("hash", "key", "n", "root", "print", block.alias("block"), F.explode(others).alias("other"))
    spread = spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    def run(batches):
        kept = None
        for batch in _with_end(batches):
            if batch is not None and not batch.num_rows:
                continue
            if batch is not None:
                new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "i", "j", "key", "n", "root")]
                new.append(np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint8).reshape(-1, BITS // 8))
                new.append(batch.column("block").to_numpy(zero_copy_only=False))
                kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new, strict=True)]
            if kept is None:
                continue
            edges = np.flatnonzero((np.diff(kept[0]) != 0) | (np.diff(kept[1]) != 0) | (np.diff(kept[2]) != 0)) + 1
            stops = [*edges, len(kept[0])] if batch is None else list(edges)  # the last group may go on in the next batch
            start = 0
            for stop in stops:
                for a, b in _pairs(*[x[start:stop] for x in kept[3:]], similarity, small):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
                start = stop
            kept = [x[start:] for x in kept]

    parts = spread.repartition("hash", "i", "j").sortWithinPartitions("hash", "i", "j", "n", "key")
    return C.map_arrow(parts.select("hash", "i", "j", "key", "n", "root", "print", "block"), run, "a long, b long").distinct()


def _with_end(batches):
    yield from batches
    yield None


def pruned(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links that may be similar by size and wide fingerprint. ``sets``: (key, n, wide), one row for each key."""
    side = lambda end, n, p: sets.select(F.col("key").alias(end), F.col("n").alias(n), F.col("wide").alias(p))
    sized = links.join(side("a", "n", "x").drop("x"), "a").join(side("b", "m", "y"), "b").where(F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-6)
    both = sized.join(side("a", "n", "x").drop("n"), "a")

    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m"))
            most = difference(n + m, similarity).tolist()
            near = [differing(x, y) <= d for x, y, d in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), most, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return C.map_arrow(both.select("a", "b", "n", "m", "x", "y"), run, "a long, b long")


def simhash_pairs(reps: DataFrame) -> DataFrame:
    """(key, fp) -> (a, b): for each pair of fingerprints that the pigeonring filter links their first keys, and for each key the first one of its own fingerprint."""
    first = C.materialize(reps.groupBy("fp").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")), "similar-fingerprints")
    links = simhash.near_links(first.select("fp"))
    named = lambda end: first.select(F.col("fp").alias(end), F.col("least").alias(f"key_{end}"))
    across = links.distinct().join(named("a"), "a").join(named("b"), "b").select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
    within = C.join_small(reps, first.where("n > 1").select("fp", "least"), "fp", "inner", BROADCAST_ROWS).where("key <> least").select(F.col("least").alias("a"), F.col("key").alias("b"))
    return across.unionByName(within)


def verified_links(links: DataFrame, keyed: DataFrame, k: int, similarity: float) -> DataFrame:
    """The links whose documents' shingle sets are at least so similar. ``keyed``: (key, text); two empty texts are alike."""
    ends = C.materialize(links.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "similar-ends")

    def hashes(batches):
        for batch in C.small_batches(batches, "text"):
            found = [shingle_hashes(t or "", k).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(pa.int64()))], names=["key", "hashes"])

    texts = C.join_small(keyed, ends, "key", "left_semi", BROADCAST_ROWS).dropDuplicates(["key"])
    sets = C.materialize(C.map_arrow(texts.select("key", "text"), hashes, "key long, hashes array<long>"), "similar-hashes")
    # each link meets at its first end, whose set comes once; ends of many links are salted
    many = links.groupBy("a").agg(F.floor(F.count(F.lit(1)) / LINKS_AT_ONCE).alias("more"))
    salted = links.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("more") + 1).alias("salt"))
    places = salted.select("a", "salt", F.col("a").alias("key")).distinct().unionByName(salted.select("a", "salt", F.col("b").alias("key")))
    rows = C.join_small(sets, C.materialize(places, "similar-places"), "key", "inner", BROADCAST_ROWS)

    def check(batches):
        held = None
        for batch in batches:
            left, right = [], []
            for a, key, hashes in zip(batch.column("a").to_pylist(), batch.column("key").to_pylist(), batch.column("hashes"), strict=True):
                own = hashes.values.to_numpy()
                if a == key:
                    held = own.copy()
                    continue
                common = len(np.intersect1d(held, own, assume_unique=True))
                either = len(held) + len(own) - common
                if either == 0 or common >= similarity * either:
                    left.append(a)
                    right.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    parts = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("a") != F.col("key"))
    return C.map_arrow(parts.select("a", "key", "hashes"), check, "a long, b long")


def similar_components(narrow: DataFrame, k: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(key, id, text) -> the table of sets with key and id, and (v, root) of all keys that have a near copy."""
    frequent, counts = frequent_shingles(narrow, k)

    def sets(batches):
        import xxhash

        for batch in C.small_batches(batches, "text"):
            raw = [simhash.hash_shingles(t or "", k) for t in batch.column("text").to_pylist()]
            hashes = [np.unique(h) for h in raw]
            columns = [pa.array([len(h) for h in hashes], pa.int64()), pa.array([xxhash.xxh128_digest(h.tobytes()) for h in hashes], pa.binary()), pa.array(np.array([simhash.fingerprint(h) for h in raw], np.uint64).view(np.int64), pa.int64())]
            columns += [pa.array([parities(h) for h in hashes], pa.binary()), pa.array([wide_parities(h) for h in hashes], pa.binary()), pa.array([prefix(h, frequent, counts, similarity).view(np.int64) for h in hashes], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), *columns], names=["key", "id", "n", "digest", "fp", "print", "wide", "prefix"])

    made = C.materialize(C.map_arrow(narrow, sets, "key long, id long, n long, digest binary, fp long, print binary, wide binary, prefix array<long>"), "similar-sets")
    # one row for each key, written once: joins with it read plain shuffles, which AQE may split where an end has many links
    own = C.materialize(made.select("key", "n", "print", "wide").dropDuplicates(["key"]), "similar-own")
    prune = lambda links: pruned(links, own.select("key", "n", "wide"), similarity)
    rows = lambda reps: reps.select("key", F.explode("prefix").alias("hash"))
    more = lambda reps: simhash_pairs(reps.select("key", "fp").distinct())
    return made, components_in_rounds(made, rows, more, own.select("key", "n", "print"), prune, narrow.select("key", "text"), k, similarity)


def components_in_rounds(made: DataFrame, rows, more, own: DataFrame, prune, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """(v, root) of all documents that have a near copy: proposals of two rounds, pruned and then verified on full sets.

    ``made`` has (key, digest, ...); ``rows`` gives the (hash, key) under which documents meet, ``more`` further pairs or is None;
    ``own`` has (key, n, print) and ``texts`` (key, text); ``prune`` drops links that cannot be.
    """
    equal = made.groupBy("digest").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a <> z").select("digest", "a")
    equal = C.materialize(equal, "similar-equal")
    twins = C.materialize(C.join_small(made.select("key", "digest"), equal, "digest", "inner", BROADCAST_ROWS).where("key <> a").select("a", F.col("key").alias("b")).distinct(), "similar-twins")
    # rows that repeat id and text have one key and count once
    reps = C.join_small(made, twins.select(F.col("b").alias("key")), "key", "left_anti", BROADCAST_ROWS)
    shared = C.materialize(shared_shingles(rows(reps)), "similar-shared")
    ends = F.explode(F.array(F.struct(F.col("first").alias("a"), F.col("key").alias("b")), F.struct(F.col("before").alias("a"), F.col("key").alias("b"))))
    tried = shared.select(ends.alias("e")).select(F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b"))
    tried = (tried if more is None else tried.unionByName(more(reps))).where("a <> b").distinct()
    tried = C.materialize(tried, "similar-proposed")
    tried = C.materialize(prune(tried), "similar-tried")
    good = C.materialize(verified_links(tried, texts, k, similarity).unionByName(twins), "similar-verified")
    roots = C.materialize(connected_components(good), "similar-roots")
    # what verified links have joined needs no other link; all other rows of a shingle meet
    named = C.join_small(shared.select("hash", "key").distinct(), roots.withColumnRenamed("v", "key"), "key", "left", BROADCAST_ROWS).withColumn("root", F.coalesce("root", "key"))
    named = C.materialize(named, "similar-named")
    mixed = C.materialize(named.groupBy("hash").agg(F.min("root").alias("p"), F.max("root").alias("q"), F.count(F.lit(1)).alias("rows")).where("p <> q").select("hash", "rows"), "similar-mixed")
    # fingerprints are 60 bytes each: fewer of them are broadcast
    meet = C.join_small(C.join_small(named, mixed, "hash", "inner", BROADCAST_ROWS), own, "key", "inner", BROADCAST_ROWS // 8)
    rest = C.materialize(open_pairs(meet, similarity).join(tried, ["a", "b"], "left_anti"), "similar-open")
    rest = C.materialize(prune(rest), "similar-rest")
    found = C.materialize(verified_links(rest, texts, k, similarity), "similar-more")
    return C.materialize(connected_components(good.unionByName(found)), "similar-roots")


def drop_similar(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies left, the one with the smallest id (nulls last); columns unchanged.

    Groups are the components of all pairs of documents that are similar. Rows that repeat both id and text are one document and
    stay or go together. Texts are read again for each round of comparisons and are not shuffled while the documents to
    compare or to drop can be broadcast (their number is counted first).
    """
    held, back, (own_id, text) = C.renamed(docs, id_col, text_col)
    keyed = held.withColumn("__key", F.xxhash64(F.col(own_id).cast("string"), F.coalesce(F.col(text), F.lit(""))))
    narrow = keyed.select(F.col("__key").alias("key"), F.coalesce(F.col(own_id).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.col(text).alias("text"))
    made, roots = similar_components(narrow, k, similarity)
    members = C.join_small(made.select("key", "id"), roots.withColumnRenamed("v", "key"), "key", "inner", BROADCAST_ROWS)
    first = members.groupBy("root").agg(F.min(F.struct("id", "key"))["key"].alias("stays"))
    gone = members.join(first, "root").where("key <> stays").select(F.col("key").alias("__key"))
    gone = C.materialize(gone.distinct(), "similar-gone")
    return back(C.join_small(keyed, gone, "__key", "left_anti", BROADCAST_ROWS))
