"""Edit-distance join of names: the automata of both sides' names are walked together, subtree by subtree.

A subtree is what begins with the same DEPTH code points (names that are shorter are filled up). Two names within two edits have
beginnings that become equal when two code points are deleted from each, so that an equi-join of these shortened beginnings
proposes every pair of subtrees that can hold a match, and none is compared with all others. For each proposed pair a task
walks the minimal automata of both subtrees at once under the edit automaton (``automata.walk``). Subtrees of more than CAPACITY
names are opened: their names go on to the next depth, and pairs there must descend from the pairs that were opened. At the last
depth they are cut into blocks instead. No step passes all rows, or all of one key, through one task, the driver or a broadcast.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import automata
from . import common as C

LIMIT = automata.LIMIT
DEPTHS = (5, 10, 20)
#: Names of a subtree that are one automaton.
CAPACITY = 2048
#: Partners of a subtree that one group of a task holds.
PARTNERS = 256
#: Subtrees that are walked at once.
PAIRS_AT_ONCE = 2048
SUBTREE = "p string, block int, names array<string>, automaton binary"


def exchanged(name: Column, number: Column) -> Column:
    """``name`` with the code points at ``number mod (length - 1)`` and behind it exchanged; null numbers and short names change nothing."""
    at = F.pmod(number, F.length(name) - 1).cast("int")
    part = lambda start, n: F.substr(name, start, n)
    swapped = F.concat(part(F.lit(1), at), part(at + 2, F.lit(1)), part(at + 1, F.lit(1)), F.substr(name, at + 3))
    return F.when((F.length(name) >= 2) & number.isNotNull(), swapped).otherwise(name)


def misspelt(name: Column, key: Column) -> Column:
    """Two neighbouring code points exchanged where the unsigned crc32 of the decimal key is even."""
    h = F.crc32(key.cast("string"))
    return F.when(h % 2 == 0, exchanged(name, h)).otherwise(name)


def beginning(name: Column, depth: int) -> Column:
    """The first code points, filled up with U+0000."""
    return F.rpad(F.substring(name, 1, depth), depth, "\0")


def shortened(p: Column, depth: int) -> Column:
    """All that is left of a beginning when two of its code points are deleted."""
    left = lambda i, j: F.concat(F.substr(p, F.lit(1), i - 1), F.substr(p, i + 1, j - i - 1), F.substr(p, j + 1, F.lit(depth) - j))
    each = F.transform(F.sequence(F.lit(1), F.lit(depth - 1)), lambda i: F.transform(F.sequence(i + 1, F.lit(depth)), lambda j: left(i, j)))
    return F.array_distinct(F.flatten(each))


def _joined(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Always shuffled: both sides grow with the input; AQE may split hot keys."""
    return left.join(right.hint("merge"), on, how)


def subtree_pairs(left: DataFrame, right: DataFrame, depth: int) -> DataFrame:
    """(name, p) of both sides -> distinct (p, q, n, m): beginnings that share a shortened form, and how many names each has."""
    forms = lambda t, p, n: t.groupBy("p").agg(F.count(F.lit(1)).alias("names")).withColumn("form", F.explode(shortened(F.col("p"), depth))).withColumnsRenamed({"p": p, "names": n})
    return _joined(forms(left, "p", "n"), forms(right, "q", "m"), "form").select("p", "q", "n", "m").distinct()


def subtrees(names: DataFrame, used: DataFrame, capacity: int) -> DataFrame:
    """(name, p) and the (p, n) to build -> p, block, its sorted names and their automaton; at most about ``capacity`` names in a block."""
    block = F.pmod(F.xxhash64("name"), F.ceil(F.col("n") / capacity)).cast("int")
    held = _joined(names, used, "p").groupBy("p", block.alias("block")).agg(F.sort_array(F.collect_list("name")).alias("names"))

    def run(batches):
        for batch in C.small_batches(batches, "names", 4 << 20):
            built = [automata.packed(automata.build(words)) for words in batch.column("names").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(built, pa.binary())], names=["p", "block", "names", "automaton"])

    return C.map_arrow(held, run, SUBTREE)


def walked(pairs: DataFrame, left: DataFrame, right: DataFrame, limit: int, partners: int) -> DataFrame:
    """(p, q) and the subtrees of both sides -> (left_name, right_name, distance).

    A subtree of the left side comes once for each group of its partners, before them; subtrees with many partners have several groups.
    """
    groups = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / partners).cast("int").alias("groups"))
    first = _joined(left, groups, "p").select("p", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(0).alias("kind"), "names", "automaton")
    grouped = _joined(pairs, groups, "p").select("p", "q", F.pmod(F.xxhash64("q"), F.col("groups")).cast("int").alias("group"))
    others = _joined(grouped, right.select(F.col("p").alias("q"), "names", "automaton"), "q")
    # every block of p meets every block of q
    second = _joined(others, left.select("p", "block"), "p").select("p", "block", "group", F.lit(1).alias("kind"), "names", "automaton")
    rows = first.unionByName(second).repartition("p", "block", "group").sortWithinPartitions("p", "block", "group", "kind")

    def run(batches):
        import numpy as np

        names, current = None, None
        for whole in batches:
            for start in range(0, whole.num_rows, PAIRS_AT_ONCE):
                batch = whole.slice(start, PAIRS_AT_ONCE)
                lefts, left_names = ([current], [names]) if current is not None else ([], [])
                rights, right_names, met = [], [], []
                for kind, words, data in zip(batch.column("kind").to_pylist(), batch.column("names"), batch.column("automaton").to_pylist(), strict=True):
                    if kind == 0:
                        current, names = automata.unpacked(data), words.as_py()
                        lefts.append(current)
                        left_names.append(names)
                    else:
                        met.append((len(lefts) - 1, len(rights)))
                        rights.append(automata.unpacked(data))
                        right_names.append(words)
                if not met:
                    continue
                found = [[], [], []]
                for pair, x, y, distance in automata.walk(lefts, rights, np.array(met), limit):
                    found[0] += [left_names[met[p][0]][i] for p, i in zip(pair.tolist(), x.tolist(), strict=True)]
                    found[1] += [right_names[met[p][1]][i].as_py() for p, i in zip(pair.tolist(), y.tolist(), strict=True)]
                    found[2] += distance.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.string()), pa.array(found[2], pa.int32())], names=["left_name", "right_name", "distance"])

    return C.map_arrow(rows.select("kind", "names", "automaton"), run, "left_name string, right_name string, distance int")


def join_names(left: DataFrame, right: DataFrame, limit: int = LIMIT, depths: tuple[int, ...] = DEPTHS, capacity: int = CAPACITY, partners: int = PARTNERS) -> DataFrame:
    """Two tables of one name column -> (left_name, right_name, distance): every pair of different spellings at most ``limit`` edits apart, once.

    An edit is an insertion, deletion or substitution of one code point or an exchange of two adjacent ones, no substring edited twice
    (optimal string alignment). Null and empty names take no part, repeated ones count once; ``limit`` is 0, 1 or 2.
    """
    if not 0 <= limit <= automata.LIMIT:
        raise ValueError(f"distances up to {automata.LIMIT} are followed")
    named = lambda t, label: C.materialize(t.select(F.col(t.columns[0]).alias("name")).where("name <> ''").distinct(), label)
    a, b = named(left, "names-left"), named(right, "names-right")
    opened, parts = None, []
    for depth in depths:
        a_p, b_p = (t.withColumn("p", beginning(F.col("name"), depth)) for t in (a, b))
        pairs = subtree_pairs(a_p, b_p, depth)
        if opened is not None:
            shorter = opened[1]
            up = pairs.withColumn("x", F.substring("p", 1, shorter)).withColumn("y", F.substring("q", 1, shorter))
            pairs = _joined(up, opened[0], ["x", "y"], "left_semi").drop("x", "y")
        pairs = C.materialize(pairs, "names-pairs")
        fits = (F.col("n") <= capacity) & (F.col("m") <= capacity)
        closed = pairs if depth == depths[-1] else pairs.where(fits)
        used = lambda p, n, pairs=closed: pairs.select(F.col(p).alias("p"), F.col(n).alias("n")).distinct()
        trees = [C.materialize(subtrees(t, used(p, n), capacity), "names-subtrees") for t, p, n in ((a_p, "p", "n"), (b_p, "q", "m"))]
        parts.append(C.materialize(walked(closed.select("p", "q"), *trees, limit, partners), "names-matches"))
        if depth == depths[-1] or pairs.where(~fits).isEmpty():
            break
        rest = C.materialize(pairs.where(~fits).select(F.col("p").alias("x"), F.col("q").alias("y")), "names-opened")
        opened = rest, depth
        a, b = (C.materialize(_joined(t, rest.select(F.col(x).alias("p")).distinct(), "p", "left_semi").select("name"), "names-open") for t, x in ((a_p, "x"), (b_p, "y")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def name_links(clients: DataFrame, vendors: DataFrame, limit: int = LIMIT, client_id: str = "client_id", vendor_id: str = "vendor_id", name: str = "name") -> DataFrame:
    """Per vendor and exact distance: n_clients, first_client_id (smallest) and clients_crc (sum of unsigned crc32 of each decimal client_id).

    Vendors' names are misspelt first (``misspelt``). Rows that repeat an id count as often as they occur; null vendor ids are one
    vendor, spelt as stored; null client ids count as clients, but have neither a first id nor a crc.
    """
    spelt = vendors.select(F.col(vendor_id).cast("long").alias("vendor_id"), misspelt(F.col(name), F.col(vendor_id)).alias("right_name")).where("right_name <> ''")
    spelt = spelt.groupBy("right_name", "vendor_id").agg(F.count(F.lit(1)).alias("times"))
    ids = clients.select(F.col(client_id).cast("long").alias("id"), F.col(name).alias("left_name")).where("left_name <> ''")
    sums = ids.groupBy("left_name").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.coalesce(F.sum(F.crc32(F.col("id").cast("string"))), F.lit(0)).alias("crc"))
    links = join_names(ids.select("left_name"), spelt.select("right_name"), limit)
    met = _joined(_joined(links, sums, "left_name"), spelt, "right_name")
    total = lambda c: F.sum(F.col(c) * F.col("times"))
    return met.groupBy("vendor_id", "distance").agg(total("n").alias("n_clients"), F.min("first").alias("first_client_id"), total("crc").alias("clients_crc"))
