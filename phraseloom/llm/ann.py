"""Approximate nearest neighbours by cosine: a random-projection forest, one shared queue, exact reranking of leaf candidates.

The forest is fitted on a bounded sample; every distinct vector is indexed under its leaf of each tree, and every query
under the leaves that its queue opens. Both are dealt by leaf, so that a query meets the rows of its leaves and no
others; these candidates are scored exactly, in double precision, and each task keeps the few best of each query. Equal vectors
are one entry with their smallest ids, which loses nothing: they score alike, and ties go to smaller ids. Large leaves are split
into blocks of rows and of queries that meet pairwise, so that no task holds a leaf.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import forest as trees

NEIGHBOURS = 5
TREES = 24
#: Leaves of a tree, as many at every size of the table unless they would hold fewer than LEAF rows.
LEAVES = 128
#: Rows that are not split any further: more than ``NEIGHBOURS`` stay together, so that no query finds fewer than there are.
LEAF = 16
SAMPLE = 32_768
SEED = 7
#: Rows (as a share of the table, counted in each tree anew) whose leaves the queue opens at most. Data without structure need
#: that many: in 64 dimensions the nearest neighbours of random vectors are hardly nearer than other rows.
SHARE = 1.2
#: Leaves farther away than this are not opened. The unit is how far the k-th neighbour found in the sample strays across a
#: random direction (squared distance over dimensions), so that neighbours that are near close the search early.
REACH = 0.25
#: Rows and queries of a leaf that meet at once.
ROWS_AT_ONCE = 1024
QUERIES_AT_ONCE = 4096
#: Queries whose leaves are looked for by one task.
QUERIES_OF_TASK = 256
#: Results that a task holds before it passes them on.
HELD = 400_000
#: Rounding slack of the products of matrices, within which pairs are scored again one by one.
SLACK = 1e-12
BROADCAST_ROWS = 200_000


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def cosines_of(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of pairs (i, j), each summed in one fixed order, so that equal vectors score equally wherever they lie."""
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 14):
        part = slice(at, at + (1 << 14))
        out[part] = (a[i[part]] * b[j[part]]).sum(axis=1)
    return out


class _Best:
    """The ``k`` best rows of each query so far, rows by number; nearest first, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.parts, self.floor, self.pending = k, [], {}, 0

    def add(self, query: np.ndarray, score: np.ndarray, rest: np.ndarray) -> None:
        """``rest``: for every pair the deciding id and the two halves of the row's key."""
        self.parts.append((query, score, rest))
        self.pending += len(query)

    def settle(self) -> None:
        """Keep the best; a row found in several leaves counts once."""
        if not self.parts:
            return
        query, score, rest = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((rest[:, 2], rest[:, 1], rest[:, 0], -score, query))
        query, score, rest = query[order], score[order], rest[order]
        fresh = np.ones(len(query), bool)
        fresh[1:] = (query[1:] != query[:-1]) | (rest[1:] != rest[:-1]).any(axis=1)
        query, score, rest = query[fresh], score[fresh], rest[fresh]
        first = np.flatnonzero(np.diff(query, prepend=query[0] - 1 if len(query) else 0))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        keep = rank < self.k
        full = rank == self.k - 1
        self.floor = dict(zip(query[full].tolist(), score[full].tolist(), strict=True))
        self.parts, self.pending = [(query[keep], score[keep], rest[keep])], 0

    def floors(self, queries: np.ndarray) -> np.ndarray:
        get = self.floor.get
        return np.array([get(q, -np.inf) for q in queries.tolist()])

    def taken(self) -> pa.RecordBatch:
        self.settle()
        query, score, rest = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 3), np.int64))
        self.parts, self.floor = [], {}
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(score), *[pa.array(np.ascontiguousarray(rest[:, c])) for c in range(3)]], names=["query_id", "score", "least", "h", "first"])


def candidates(batches, dims: int, k: int):
    """Rows of one (leaf, row block, query block) follow one another, queries first; yields the best pairs of the task."""
    best, queries, at = _Best(k), None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        units = _unit(_matrix(batch.column("v"), dims))
        where = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "part", "asked_part", "is_row")], axis=1)
        ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "second", "h")], axis=1)
        edges = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *edges], [*edges, len(where)], strict=True):
            group = tuple(where[a, :3])
            if not where[a, 3]:
                if queries is not None and at == group:  # the queries of a group go on from the batch before
                    queries = np.concatenate([queries[0], ids[a:b, 0]]), np.concatenate([queries[1], units[a:b]])
                else:
                    queries, at = (ids[a:b, 0], units[a:b]), group
                continue
            if queries is None or at != group:
                continue
            own, vectors = queries
            for c in range(a, b, ROWS_AT_ONCE):
                first, second, h = ids[c : min(c + ROWS_AT_ONCE, b)].T
                rows = units[c : min(c + ROWS_AT_ONCE, b)]
                # of a vector that several ids share the query's own id doesn't count; second is 0 bits beyond first where there is none
                same = first[:, None] == own[None, :]
                rough = np.where(same & (second == first)[:, None], -np.inf, rows @ vectors.T)
                floor = best.floors(own)
                if len(rows) > k:
                    floor = np.maximum(floor, np.partition(rough, len(rows) - k, axis=0)[len(rows) - k])
                r, q = np.nonzero((rough >= floor[None, :] - SLACK) & (rough > -np.inf))
                if len(r):
                    least = np.where(same[r, q], second[r], first[r])
                    best.add(own[q], cosines_of(rows, vectors, r, q), np.stack([least, h[r], first[r]], axis=1))
                if best.pending > HELD:
                    best.settle()
                    if len(best.parts[0][0]) > HELD:
                        yield best.taken()
    yield best.taken()


def nearest_neighbours(table: DataFrame, is_query: Column, k: int = NEIGHBOURS, share: float = SHARE, reach: float = REACH, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, nearest first, ties to the smaller id.

    ``is_query`` picks the queries among the rows; candidates are all rows of other ids. Vectors that are null, zero, or hold
    null or non-finite components take no part, nor do rows without id or of a length other than the most frequent one (the
    shorter on a tie). A query id that occurs again is asked once, with the smallest of its vectors; repeated candidates count
    as often as they occur. A table with one usable row, or none, gives no rows.
    """
    spark = table.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked")).where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims = sizes["dims"]
    rows = rows.where(F.size("v") == dims)
    # of each distinct vector: the k + 1 smallest ids, each with the number of its rows
    each = rows.groupBy("v", "id").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    each = each.withColumn("place", rank).where(F.col("place") <= k + 1)
    kept = F.array_sort(F.collect_list(F.struct("id", F.least("n", F.lit(k)).cast("int").alias("n"))))
    distinct = each.groupBy("v").agg(kept.alias("ids")).withColumn("h", F.xxhash64("v")).withColumn("first", F.col("ids")[0]["id"])
    distinct = C.materialize(distinct.withColumn("second", F.when(F.size("ids") > 1, F.col("ids")[1]["id"]).otherwise(F.col("first"))), "ann-distinct")
    asked = C.materialize(rows.where("asked").groupBy("id").agg(F.min("v").alias("v")), "ann-asked")

    sample = distinct.orderBy(F.xxhash64(F.lit(SEED), "h"), "h", "first").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    sample = sample if isinstance(sample, pa.Array) else pa.concat_arrays(sample.chunks)
    units = _unit(_matrix(sample, dims)).astype(np.float32)
    built = trees.build(units, TREES, max(LEAF, -(-len(units) // LEAVES)), SEED)
    forest = spark.sparkContext.broadcast((built, units, trees.place(built, units)))  # bounded by the sample

    def index(batches):
        own, _, _ = forest.value
        for batch in batches:
            if batch.num_rows:
                leaves = trees.place(own, _unit(_matrix(batch.column("v"), dims)).astype(np.float32)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("h", "first", "second", "v")], pa.FixedSizeListArray.from_arrays(pa.array(leaves.ravel()), TREES).cast(pa.list_(pa.int32()))], names=["h", "first", "second", "v", "leaves"])

    def search(batches):
        own, units, places = forest.value
        for batch in batches:
            if batch.num_rows:
                found = []
                for u in _unit(_matrix(batch.column("v"), dims)).astype(np.float32):
                    leaves = trees.place(own, u[None])[0]
                    near = np.sort(units[(places == leaves).any(axis=1)] @ u)[::-1]
                    # the query itself may be of the sample: one more than k
                    far = max(0.0, 2 - 2 * float(near[k])) if len(near) > k else 4.0
                    found.append(trees.probe(own, u, share, reach * far / dims))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(found, pa.list_(pa.int32()))], names=["id", "v", "leaves"])

    kind = dict(rows.dtypes)["v"]
    indexed = C.materialize(C.map_arrow(distinct.select("h", "first", "second", "v"), index, f"h long, first long, second long, v {kind}, leaves array<int>"), "ann-index")
    asked = asked.repartition(asked.count() // QUERIES_OF_TASK + 1, "id")  # a query takes milliseconds, its row is small
    probed = C.materialize(C.map_arrow(asked, search, f"id long, v {kind}, leaves array<int>"), "ann-queries")
    # blocks of each leaf: numbers bounded by the forest's size
    blocks = lambda t, name, most: t.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    sized = C.materialize(blocks(indexed, "parts", ROWS_AT_ONCE).join(blocks(probed, "asked_parts", QUERIES_AT_ONCE), "leaf").coalesce(1), "ann-leaves")
    of_leaf = F.broadcast(sized)  # one row for each leaf, TREES * LEAVES about
    row_side = indexed.select("h", "first", "second", "v", F.explode("leaves").alias("leaf")).join(of_leaf, "leaf").select("leaf", F.pmod("h", "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("asked_parts") - 1)).alias("asked_part"), F.lit(1).alias("is_row"), "first", "second", "h", "v")
    query_side = probed.select("id", "v", F.explode("leaves").alias("leaf")).join(of_leaf, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("id"), "asked_parts").cast("int").alias("asked_part"), F.lit(0).alias("is_row"), F.col("id").alias("first"), F.col("id").alias("second"), F.lit(0).cast("long").alias("h"), "v")
    dealt = row_side.unionByName(query_side).repartition("leaf", "part", "asked_part").sortWithinPartitions("leaf", "part", "asked_part", "is_row")
    local = C.map_arrow(dealt, lambda batches: candidates(batches, dims, k), "query_id long, score double, least long, h long, first long")
    local = local.groupBy("query_id", "h", "first").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "least"))
    top = C.materialize(local.withColumn("place", place).where(F.col("place") <= k).select("query_id", "h", "first", "score"), "ann-top")
    # only vectors of several rows stand for more than their first id
    several = C.materialize(distinct.where((F.size("ids") > 1) | (F.col("ids")[0]["n"] > 1)).select("h", "first", "ids"), "ann-several")
    full = C.join_small(top, several, ["h", "first"], "left", BROADCAST_ROWS)
    one = F.array(F.struct(F.col("first").alias("id"), F.lit(1).alias("n")))
    full = full.select("query_id", "score", F.explode(F.coalesce("ids", one)).alias("x")).where(F.col("x.id") != F.col("query_id"))
    full = full.select("query_id", F.col("x.id").alias("vec_id"), "score", F.explode(F.sequence(F.lit(1), F.col("x.n"))))
    final = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return full.withColumn("rank", final).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
