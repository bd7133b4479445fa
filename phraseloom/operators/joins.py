"""Lookups, semi and anti joins, and the match of new rows against an inventory.

Which side is small isn't known here: no side is broadcast by a hint. Spark broadcasts by its size estimate, and AQE turns
joins into broadcasts or splits skewed partitions by measured sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import text as T
from phraseloom.operators.dedup import best_row
from phraseloom.operators.near import near_pairs
from phraseloom.operators.windows import running_number
from phraseloom.sources.scratch import scratch_folder


def add_metadata(df: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Left join of a table with one row per key (JN1)."""
    return df.join(source, key, "left")


def fill_from(df: DataFrame, source: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Nulls of ``columns`` (target: source column) filled from the source's row of the same key; no helper columns stay (JN2)."""
    side = source.select(F.col(key), *[F.col(s).alias(f"__src_{t}") for t, s in columns.items()])
    joined = df.join(side, key, "left").withColumns({t: F.coalesce(t, f"__src_{t}") for t in columns})
    return joined.select(*df.columns)


def resolve_ids(results: DataFrame, raw: DataFrame, result_id: str = "custom_id", raw_id: str = "idiom_id", position: str = "_pos") -> DataFrame:
    """Rows of ``raw`` for result ids: by id (the last row of a repeated one), else by the trailing number as position; unmatched results go (JN3)."""
    last = best_row(raw.where(F.col(raw_id).isNotNull()), [raw_id], [F.desc(position)])
    side = last.select(F.col(raw_id).alias("__id"), F.struct(*raw.columns).alias("raw"))
    by_id = results.join(side, results[result_id] == side["__id"], "left").drop("__id")
    at = F.regexp_extract(F.col(result_id), r"(\d+)$", 1).try_cast("long")
    positions = raw.select(F.col(position).alias("__at"), F.struct(*raw.columns).alias("__by_pos"))
    joined = by_id.withColumn("__n", F.when(F.col("raw").isNull(), at)).join(positions, F.col("__n") == F.col("__at"), "left")
    return joined.withColumn("raw", F.coalesce("raw", "__by_pos")).where("raw is not null").select(*results.columns, "raw")


def not_in(df: DataFrame, inventory: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Anti join (JN4, JN5, FLT27, ST5)."""
    return df.join(inventory, on, "left_anti")


def only_in(df: DataFrame, inventory: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Semi join (JN6)."""
    return df.join(inventory, on, "left_semi")


def rest_of_broad(high: DataFrame, broad: DataFrame, on: Sequence[str]) -> DataFrame:
    """High rows and the broad rows whose key isn't among them (JN4)."""
    return high.unionByName(broad.join(high.select(*on), list(on), "left_anti"), allowMissingColumns=True)


def group_feature(df: DataFrame, key: Column | str, counted: Column | str, name: str) -> DataFrame:
    """The number of distinct non-null ``counted`` values of each row's key (JN7, AG23): aggregated, then joined back."""
    keyed = df.withColumn("__key", T.col(key))
    counts = keyed.groupBy("__key").agg(F.count_distinct(T.col(counted)).alias(name))
    return keyed.join(counts.withColumnRenamed("__key", "__k"), F.col("__key").eqNullSafe(F.col("__k")), "left").drop("__key", "__k")


def match_status(new: DataFrame, main: DataFrame, idiom: str = "idiom", meaning: str = "meaning", example: str = "example", position: str = "_pos", with_ratio: bool = True, least_ratio: float = 0.92) -> DataFrame:
    """Each new row with ``status`` and ``matched_meaning`` (JN8-JN10, SC37-SC39).

    In order: missing idiom, exact triple, known pair, known idiom without a meaning, near-duplicate of a known meaning (the first
    by the inventory's position), new meaning, new idiom. The inventory is read once: its distinct triples are written, and pairs and
    idioms are summed up from them. Meanings of one idiom meet as ``near`` describes; rows without an idiom are kept out of all joins.
    """
    spark = new.sparkSession
    view = lambda df: df.withColumns({"__i": T.idiom_key(idiom), "__m": T.idiom_key(meaning), "__e": T.example_key(example)})
    triples = view(main).where("__i <> ''").groupBy("__i", "__m", "__e").agg(F.min(position).alias("__at"))
    path = scratch_folder(spark, "match-inventory")
    triples.write.parquet(path)
    triples = spark.read.schema(triples.schema).parquet(path)
    pairs = triples.groupBy("__i", "__m").agg(F.min("__at").alias("__at"))
    known = triples.select("__i").distinct()
    flag = lambda name: F.lit(True).alias(name)
    n = view(new)
    own = n.where("__i <> ''")
    rows = own.join(triples.select("__i", "__m", "__e", flag("__triple")), ["__i", "__m", "__e"], "left")
    rows = rows.join(pairs.select("__i", "__m", flag("__pair")), ["__i", "__m"], "left").join(known.select("__i", flag("__known")), "__i", "left")
    is_known = F.coalesce("__known", F.lit(False))
    rows = rows.withColumn("status", F.when(F.col("__triple"), "remove_exact_duplicate_of_main").when(F.col("__pair"), "remove_duplicate_idiom_meaning_of_main").when(is_known & (F.col("__m") == ""), "remove_existing_idiom_without_new_meaning").when(~is_known, "keep_new_idiom"))
    # each new meaning of a known idiom once, against each of its known meanings once
    side = lambda df: df.where("__m <> ''").select(F.col("__i").alias("key"), F.col("__m").alias("text"))
    near = near_pairs(side(rows.where("status is null")).distinct(), side(pairs), least_ratio=least_ratio if with_ratio else None)
    placed = near.join(pairs.select(F.col("__i").alias("key"), F.col("__m").alias("other"), "__at"), ["key", "other"])
    first = placed.groupBy("key", "text").agg(F.min_by("other", F.struct("__at", "other")).alias("matched_meaning")).withColumnsRenamed({"key": "__i", "text": "__m"})
    out = rows.join(first, ["__i", "__m"], "left")
    matched = F.when(F.col("status").isNull(), F.col("matched_meaning"))
    status = F.coalesce("status", F.when(matched.isNotNull(), "remove_near_duplicate_meaning_of_main").otherwise("keep_new_meaning_for_existing_idiom"))
    found = out.select(*new.columns, status.alias("status"), F.coalesce(matched, F.lit("")).alias("matched_meaning"))
    return found.unionByName(n.where("__i = ''").select(*new.columns, F.lit("remove_missing_idiom").alias("status"), F.lit("").alias("matched_meaning")))


def crawl_stored(pages: DataFrame, links: DataFrame, seeds: DataFrame, limit: int, depth: int | None = None) -> DataFrame:
    """Breadth-first traversal of stored pages: (at, term, depth) of the first ``limit`` pages reached (JN11).

    ``pages`` has the terms that have a page, ``links`` (term, at, other), ``seeds`` (term, at). One round joins the links of the last round's
    terms, keeps what has a page and was not seen, and numbers it by the place of the term that leads to it first, then by the
    link's. A round is a written table; each term is in one of them, so that rounds shrink to nothing, or to the limit or the depth.
    """
    spark = pages.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_folder(spark, "crawl")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    known = pages.select("term").distinct()
    place = lambda df, order: running_number(df, order, "at", 0)
    first = seeds.join(known, "term", "left_semi").groupBy("term").agg(F.min("at").alias("place"))
    frontier = written(place(first, ["place", "term"]).select("at", "term", F.lit(0).alias("depth")))
    found, count, round_ = frontier, frontier.count(), 0
    while count < limit and (depth is None or round_ < depth):
        round_ += 1
        led = frontier.select(F.col("at").alias("from"), "term").join(links.select("term", F.col("at").alias("link"), "other"), "term")
        new = led.groupBy(F.col("other").alias("term")).agg(F.min(F.struct("from", "link")).alias("place"))
        new = new.join(known, "term", "left_semi").join(found.select("term"), "term", "left_anti")
        frontier = written(place(new, ["place", "term"]).select((F.col("at") + count).alias("at"), "term", F.lit(round_).alias("depth")))
        more = frontier.count()
        if not more:
            break
        found, count = written(found.unionByName(frontier)), count + more
    return found.where(F.col("at") < limit)
