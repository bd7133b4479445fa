"""Window operators, sorting, sampling, splitting and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phraseloom.functions import text as T
from phraseloom.sources.scratch import scratch_folder


def numbered(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], name: str = "rank", start: int = 1) -> DataFrame:
    """Running number within each key (WN1, WN2, WN4, WN5)."""
    w = Window.partitionBy(*[T.col(k) for k in keys]).orderBy(*[T.col(o) for o in order])
    return df.withColumn(name, (F.row_number().over(w) - 1 + start).cast("int"))


def top_n(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key, numbered (WN1-WN3, WN6, WN11)."""
    return numbered(df, keys, order, name).where(F.col(name) <= n)


def split_adversarial(df: DataFrame, order: Sequence[Column | str], row_type: str = "row_type", idiom: str = "idiom_id") -> DataFrame:
    """At most two adversarial rows of each idiom, renamed _1 and _2; other rows pass (WN1-WN3)."""
    adversarial = F.contains(F.lower(F.coalesce(F.col(row_type), F.lit(""))), F.lit("adversarial"))
    kept = top_n(df.where(adversarial), [idiom], order, 2, "__rank")
    kept = kept.withColumn(row_type, F.concat(F.lit("adversarial_example_"), F.col("__rank"))).drop("__rank")
    return df.where(~adversarial).unionByName(kept)


def ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` dealt out by ranges of the whole order and sorted, as a written table with ``__range`` and the running ``__at``.

    Ranges are found from a sample, so that they may differ when they are found again: the table is written once. Rows that are equal in
    the order cannot part; orders that end in a unique position have none.
    """
    spark = df.sparkSession
    by = [T.col(o) for o in order]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    path = scratch_folder(spark, "ranges")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def running_number(df: DataFrame, order: Sequence[Column | str], name: str = "number", start: int = 1) -> DataFrame:
    """Numbers of all rows in one order: ranges of the order are sorted in parallel, and only their counts meet in one task (SL2, WN7-WN9)."""
    dealt = ranges(df, order)
    counts = dealt.groupBy("__range").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select("__range", (F.coalesce(upto, F.lit(0)) - F.col("first") + start).alias("__shift"))
    numbered_ = dealt.join(F.broadcast(shifts), "__range")  # a row for each partition
    return numbered_.withColumn(name, F.col("__at") + F.col("__shift")).drop("__range", "__at", "__shift")


def pair_ids(df: DataFrame, keys: Sequence[str], complete: Column | None = None, infix: str = "_pair_", name: str = "minimal_pair_id") -> DataFrame:
    """A running number over the sorted distinct key tuples, as ``<first key><infix><number>`` (WN7-WN9).

    With ``complete`` (a boolean aggregate of a pair) only such pairs are numbered, others get null. Rows get their id by a join and
    are neither sorted nor numbered themselves.
    """
    pairs = df.groupBy(*keys).agg((F.lit(True) if complete is None else complete).alias("__complete")).where("__complete").drop("__complete")
    ids = running_number(pairs, keys, "__n")
    ids = ids.select(*[F.col(k).alias(f"__{k}") for k in keys], F.concat(F.col(keys[0]).cast("string"), F.lit(infix), F.col("__n").cast("string")).alias(name))
    rows = df.drop(name)
    same = [rows[k].eqNullSafe(ids[f"__{k}"]) for k in keys]
    return rows.join(ids, same, "left").drop(*[f"__{k}" for k in keys])


def fill_both_ways(df: DataFrame, key: str, column: str, position: str = "_pos") -> DataFrame:
    """Nulls of a group filled from the rows before, else after (WN10).

    Rows are dealt out by ranges of key and position, so that a large key spreads over many; rows meet within a range of their key, and between
    ranges only the first and last value of each is carried.
    """
    rows = ranges(df, [key, position])
    # what follows is what precedes in the reversed order: a frame up to the end would be read again for each row
    upto = lambda *by: Window.partitionBy(key, "__range").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    before = F.last(column, ignorenulls=True).over(upto(F.asc(position), F.asc("__at")))
    after = F.last(column, ignorenulls=True).over(upto(F.desc(position), F.desc("__at")))
    known = F.col(column).isNotNull()
    ends = rows.groupBy(key, "__range").agg(F.max_by(column, F.when(known, F.col(position))).alias("__last"), F.min_by(column, F.when(known, F.col(position))).alias("__first"))
    others = lambda by: Window.partitionBy(key).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col(key).alias("__key"), F.col("__range").alias("__part"), F.last("__last", ignorenulls=True).over(others(F.asc("__range"))).alias("__before"), F.last("__first", ignorenulls=True).over(others(F.desc("__range"))).alias("__after"))
    filled = rows.withColumns({"__up": before, "__down": after}).join(carried, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__range") == F.col("__part")))
    return filled.withColumn(column, F.coalesce("__up", "__before", "__down", "__after")).select(*df.columns)


def best_value(df: DataFrame, keys: Sequence[str], value: str, score: Column, position: Column) -> DataFrame:
    """The value with the highest score of each key, the first on ties (WN12), partially aggregated."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(score, -position)).alias(value))


def order_by_map(df: DataFrame, column: str, ranks: Mapping[str, int], *rest: Column | str, otherwise: int = 99) -> DataFrame:
    """Sort by a custom order of values, then the rest (SL1, SL2)."""
    return df.orderBy(T.lookup(F.col(column), dict(ranks), otherwise), *rest)


def head(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """Top n (SL3, SL5): a bounded heap per task, no full sort."""
    return df.orderBy(*[T.col(o) for o in order]).limit(n)


def scanned(df: DataFrame, n: int, position: str = "_pos") -> DataFrame:
    """The first n rows by position (SL4)."""
    return df.where(F.col(position) < n)


def sample(df: DataFrame, key: Column | str, n: int, seed: int = 42) -> DataFrame:
    """A reproducible sample of n rows by a seeded hash (SL6-SL8); the same rows whatever the partitions."""
    return df.orderBy(F.md5(F.concat(T.col(key).cast("string"), F.lit(str(seed))).cast("binary")), T.col(key)).limit(n)


def bucket(key: Column | str, buckets: int = 100) -> Column:
    """A stable bucket of a key, the same in any engine with md5."""
    digits = F.substring(F.md5(T.col(key).cast("string").cast("binary")), 1, 4)
    return F.pmod(F.conv(digits, 16, 10).cast("int"), F.lit(buckets))


def split_by_key(df: DataFrame, key: Column | str, train: int = 80) -> DataFrame:
    """``split`` = train or test by the key's bucket: rows of a key never part, and nothing is shuffled (SL9, SL10)."""
    return df.withColumn("split", F.when(bucket(key) < train, "train").otherwise("test"))


def split_overlap(df: DataFrame, key: Column | str) -> DataFrame:
    """One row: keys in both splits, 0 for a split without leakage (SL10)."""
    sides = df.groupBy(T.col(key).alias("k")).agg(F.count_distinct("split").alias("n"))
    return sides.agg(F.count_if(F.col("n") > 1).alias("overlap"))


def tier_split(df: DataFrame, tier: str, split: str) -> DataFrame:
    """One cell of tier x split (SL11)."""
    return df.where((F.col("tier") == tier) & (F.col("split") == split))


def union_keys(*frames: DataFrame) -> DataFrame:
    """Distinct union of one-column key tables, sorted (ST2)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct().orderBy(out.columns[0])


def overlap(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of the columns that both tables have (ST3)."""
    return a.select(*columns).intersect(b.select(*columns))
