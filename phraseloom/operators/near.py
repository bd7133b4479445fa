"""Near-duplicate meanings of one idiom: two similarity joins that do not compare all pairs in Python.

Token sets of a Jaccard similarity t share a token among the first n - ceil(t n) + 1 of each in any one order (a prefix): an equi-join on
(idiom, token) proposes every such pair. The sequence ratio is 2 M / (length + length), and its matched characters M cannot be
more than those that both texts have in common, by count: texts meet by idiom in blocks of rows, counts of characters are compared
as arrays, and only pairs within that bound are measured.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import similarity as S
from phraseloom.functions import text as T
from phraseloom.shipping import ship

#: Meanings of one idiom and side in a block: two blocks of each side meet in one group.
BLOCK_ROWS = 2048
#: Classes that characters are counted in.
CLASSES = 64
#: Texts of one side that are compared with a block at once.
AT_ONCE = 32


def _prefix(tokens: Column, least: float) -> Column:
    """The first tokens of a set by hash, enough to meet any set so similar; the empty set has one token of its own."""
    n = F.size(tokens)
    by_hash = F.transform(F.array_sort(F.transform(tokens, lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("t")))), lambda s: s["t"])
    width = n - F.ceil(least * n - F.lit(1e-9)).cast("int") + 1
    return F.when(n == 0, F.array(F.lit(""))).otherwise(F.slice(by_hash, F.lit(1), F.greatest(width, F.lit(1))))


def jaccard_pairs(new: DataFrame, main: DataFrame, least: float = 0.85) -> DataFrame:
    """(key, text) of both sides -> (key, text, other) whose token sets are at least so similar (SC37)."""
    side = lambda df, name, tokens: df.select("key", F.col("text").alias(name), T.word_set("text").alias(tokens)).withColumn("token", F.explode(_prefix(F.col(tokens), least)))
    met = side(new, "text", "x").join(side(main, "other", "y"), ["key", "token"])
    sizes = F.least(F.size("x"), F.size("y")) >= least * F.greatest(F.size("x"), F.size("y")) - 1e-9
    return met.where(sizes).where(S.jaccard(F.col("x"), F.col("y")) >= least).select("key", "text", "other").distinct()


def counted_characters(texts: list[str]) -> np.ndarray:
    """(texts, CLASSES) counts: classes of code points only add to what two texts have in common."""
    out = np.zeros((len(texts), CLASSES), np.int32)
    for row, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        out[row] = np.bincount(points % CLASSES, minlength=CLASSES)
    return out


def within_bound(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: float):
    """Pairs of rows whose ratio can be ``least``, by what they have in common at most."""
    for at in range(0, len(y), AT_ONCE):
        total = n[:, None] + m[None, at : at + AT_ONCE]
        i, j = np.nonzero(2 * np.minimum(n[:, None], m[None, at : at + AT_ONCE]) >= least * total - 1e-9)
        common = np.minimum(x[i], y[at + j]).sum(axis=1)
        good = 2 * common >= least * (n[i] + m[at + j]) - 1e-9
        yield from zip(i[good].tolist(), (at + j[good]).tolist(), strict=True)


def ratio_pairs(new: DataFrame, main: DataFrame, least: float = 0.92, block_rows: int = BLOCK_ROWS, measured: bool = False) -> DataFrame:
    """(key, text) of both sides -> (key, text, other) whose sequence ratio is at least so high (SC38).

    A key of many texts is cut into blocks, and every block of one side meets every block of the other in a group of its own.
    ``measured`` gives all pairs within the bound instead, those that are measured.
    """
    ship(new.sparkSession)
    count = lambda df, n: df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(n))
    blocks = count(new, "i_blocks").join(count(main, "j_blocks"), "key")
    own = lambda n: F.pmod(F.xxhash64("text"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = new.join(blocks, "key").select("key", own("i_blocks").alias("i"), every("j_blocks").alias("j"), F.lit(0).alias("side"), "text")
    right = main.join(blocks, "key").select("key", every("i_blocks").alias("i"), own("j_blocks").alias("j"), F.lit(1).alias("side"), "text")
    rows = left.unionByName(right).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")

    def run(batches):
        from difflib import SequenceMatcher

        group, held, counts, sizes = None, [], None, None

        def compare(others):
            nonlocal counts, sizes
            if counts is None:
                counts, sizes = counted_characters(held), np.array([len(t) for t in held])
            matcher = SequenceMatcher(None)
            last = None
            for i, j in within_bound(counts, counted_characters(others), sizes, np.array([len(t) for t in others]), least):
                if not measured:
                    if j != last:
                        matcher.set_seq2(others[j])
                        last = j
                    matcher.set_seq1(held[i])
                    if matcher.ratio() < least:
                        continue
                yield group[0], held[i], others[j]

        def table(found):
            columns = list(zip(*found, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["key", "text", "other"])

        for batch in batches:
            found, others = [], []
            for key, i, j, side, text in zip(*[batch.column(c).to_pylist() for c in ("key", "i", "j", "side", "text")], strict=True):
                if (key, i, j) != group:
                    if others:
                        found += compare(others)
                    group, held, counts, others = (key, i, j), [], None, []
                if side == 0:
                    held.append(text)
                else:
                    others.append(text)
            if others:
                found += compare(others)
            yield table(found)

    return rows.select("key", "i", "j", "side", "text").mapInArrow(run, "key string, text string, other string")


def near_pairs(new: DataFrame, main: DataFrame, least_jaccard: float = 0.85, least_ratio: float | None = 0.92, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, text) of both sides, distinct and not empty -> distinct (key, text, other) that are near by either measure (SC39)."""
    pairs = jaccard_pairs(new, main, least_jaccard)
    return pairs if least_ratio is None else pairs.unionByName(ratio_pairs(new, main, least_ratio, block_rows)).distinct()
