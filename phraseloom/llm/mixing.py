"""Mixing sources to target weights by capped water-filling with seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 42
#: Hash cells per source: the fractional part is cut at a cell's edge, and only the cell at the cut is ordered by row.
CELLS = 4096
#: The plan has one row per source; above this counted number it is joined by a shuffle.
MAX_BROADCAST_SOURCES = 200_000


def size_of(text: Column) -> Column:
    """Words between blanks, tabs and line breaks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources: (source, source_size) -> + target.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes; a source above
    ``max_epochs`` times its size is clamped there and the excess is shared again by weight until none is above.
    That fixed point is min(cap, level * weight): in order of cap/weight the clamped sources come first, so the level
    follows from running sums. One row per source: the only unpartitioned window here runs over that small table.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(order) - 1
    # bytes of UTF-8 sort as code points do
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (n % len(weights) + 1).cast("int")).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs)
    ratio = F.col("cap") / F.col("weight")
    run = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("cap").over(run), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(run), F.lit(0))
    leveled = weighed.withColumn("level", left / weight_left).withColumn("clamped", ratio <= F.col("level"))
    level = F.min(F.when(~F.col("clamped"), F.struct(ratio.alias("r"), F.col("level").alias("level")))).over(everything)["level"]
    return leveled.select("source", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"))


def seeded_place(id_col: Column, text: Column, seed: int) -> Column:
    """60 bits of a seeded md5 of id and text, the same in any engine: a row's place in the order in which fractional repetitions are dealt."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))
    return F.conv(F.substring(digits, 1, 15), 16, 10).cast("long")


def _placed(docs: DataFrame, seed: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with __size, __place (seeded hash) and __cell (its highest 12 bits)."""
    place = seeded_place(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")), seed)
    return docs.withColumns({"__size": size_of(F.col(text_col)), "__place": place}).withColumn("__cell", F.shiftrightunsigned("__place", 48).cast("int"))


def mix_plan(rows: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """From rows (doc_id, source, size, place, cell): one row per source with its target, whole repetitions and the cut.

    The rest beyond whole repetitions goes to the rows of the lower hash cells, and in the cell at the cut to the rows up to
    ``last_place``, chosen so that the sum comes nearest to the rest. Sums are pre-aggregated by (source, cell), at most
    CELLS rows for each source; only the one cell of each source at the cut is ordered by row, so no task holds a source.
    """
    cells = C.materialize(rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")), "mix-cells")
    targets = water_fill(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("source_size") * F.col("whole"))
    t = C.materialize(targets.coalesce(1), "mix-targets").alias("t")
    before = F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell")) - F.col("cell_size")
    c = cells.withColumn("before", before).alias("c")
    at_cut = (F.col("before") < F.col("t.rest")) & (F.col("before") + F.col("cell_size") >= F.col("t.rest"))
    cut = c.join(t, F.col("c.source").eqNullSafe(F.col("t.source")) & at_cut)
    cut = C.materialize(cut.select("c.source", F.col("c.cell").alias("cut_cell"), "before", "t.rest").coalesce(1), "mix-cuts")
    k = (F.broadcast(cut) if C.rows_below(cut, MAX_BROADCAST_SOURCES) else cut).alias("k")
    inside = rows.alias("r").join(k, F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.cell") == F.col("k.cut_cell"))).select("k.source", "size", "place", "before", "rest")
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("place"))
    gap = F.abs(upto - F.col("rest"))
    last = inside.withColumn("gap", gap).groupBy("source").agg(F.min(F.struct("gap", "place")).alias("best"), F.min(F.col("rest") - F.col("before")).alias("none"))
    last = last.select("source", F.when(F.col("none") <= F.col("best.gap"), F.lit(-1)).otherwise(F.col("best.place")).alias("last_place"))
    plan = t.join(cut.alias("k"), F.col("t.source").eqNullSafe(F.col("k.source")), "left").join(last.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left")
    plan = plan.select("t.source", "source_size", "target", "whole", F.coalesce("cut_cell", F.lit(-1)).alias("cut_cell"), F.coalesce("last_place", F.lit(-1)).alias("last_place"))
    return C.materialize(plan.coalesce(1), "mix-plan")


def _times(size: str, cell: str, place: str) -> Column:
    extra = (F.col(cell) < F.col("cut_cell")) | ((F.col(cell) == F.col("cut_cell")) & (F.col(place) <= F.col("last_place")))
    return F.when(F.col(size) == 0, F.lit(0)).otherwise(F.col("whole") + extra.cast("long")).cast("long")


def _with_plan(rows: DataFrame, plan: DataFrame, source_col: str) -> DataFrame:
    small = C.rows_below(plan, MAX_BROADCAST_SOURCES)
    p = (F.broadcast(plan) if small else plan).withColumnRenamed("source", "__plan_source")
    return rows.join(p, F.col(source_col).eqNullSafe(F.col("__plan_source")))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repetitions, taken (= size * repetitions).

    Every document of a source gets floor(target / source_size) whole repetitions; the rest of the target is dealt as one
    more repetition in the order of a seeded hash (see mix_plan). Reruns agree: nothing depends on partitions or row order.
    Texts without words have size 0 and take nothing. Rows that repeat id and text share a hash and are dealt together.
    A null source is a source of its own; one whose size is 0 has target 0.
    """
    rows = _placed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")), seed, "doc_id", "text")
    rows = C.materialize(rows.select("doc_id", "source", F.col("__size").alias("size"), F.col("__place").alias("place"), F.col("__cell").alias("cell")), "mix-rows")
    out = _with_plan(rows, mix_plan(rows, weights, max_epochs), "source").withColumn("repetitions", _times("size", "cell", "place"))
    return out.select("doc_id", "source", "size", "source_size", "target", "repetitions", (F.col("size") * F.col("repetitions")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with every row as often as the mix takes it, columns unchanged.

    A repetition keeps the row's id: it is the same document seen again. Documents without words take no part and go.
    """
    held, back, (own_id, text, source) = C.renamed(docs, id_col, text_col, source_col)
    own = _placed(held, seed, own_id, text)
    rows = own.select(F.col(source).alias("source"), F.col("__size").alias("size"), F.col("__place").alias("place"), F.col("__cell").alias("cell"))
    rows = C.materialize(rows, "mix-rows")
    out = _with_plan(own, mix_plan(rows, weights, max_epochs), source).withColumn("__times", _times("__size", "__cell", "__place")).where("__times > 0")
    return back(out.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))))
