"""Connected components of a link table, by rounds of hooking and contraction in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: A mapping is broadcast up to this many counted rows (16 bytes each); above it joins are shuffled and AQE may split them.
BROADCAST_ROWS = 200_000


def _follow(pairs: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace ``column`` by its image; values without one stay."""
    m = mapping.select(F.col("v").alias(column), F.col("root").alias("__root"))
    joined = C.join_small(pairs, m, column, "left", BROADCAST_ROWS)
    return joined.withColumn(column, F.coalesce("__root", column)).drop("__root")


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) longs -> (v, root): every linked node with the smallest node of its component.

    A round hooks each node that has a smaller neighbour to the smallest one, follows the hooks to their ends and
    contracts the links; only ends (nodes with no smaller neighbour) are left, so the link table shrinks by a factor
    each round whatever the shape of the component. Every step is a written table: a lost executor costs one step.
    """
    spark = links.sparkSession
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = C.materialize(links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "cc-edges")
    found = None
    while not edges.isEmpty():
        hooks = C.materialize(edges.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("root")), "cc-hooks")
        while True:
            ahead = C.materialize(_follow(hooks, "root", hooks.select("v", "root")), "cc-hooks")
            # roots only sink along the hooks: equal sums mean that none moved
            total = lambda t: t.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
            done = total(ahead) == total(hooks)
            hooks = ahead
            if done:
                break
        found = hooks if found is None else C.materialize(_follow(found, "root", hooks).unionByName(hooks), "cc-found")
        rest = _follow(_follow(edges, "a", hooks), "b", hooks).where("a <> b")
        edges = C.materialize(rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    if found is None:
        return spark.createDataFrame([], "v long, root long")
    roots = found.select(F.col("root").alias("v"), "root").distinct()
    return found.unionByName(roots)
