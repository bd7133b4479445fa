"""Deduplication and best-row selection.

All of it is one window per key with rank 1 kept: Spark prunes each task's rows to one per key before the shuffle
(WindowGroupLimit), so a key that holds a large share of the rows costs each task one row. Every ordering must end in a unique
position column; nothing depends on partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phraseloom.functions import text as T

POSITION = "_pos"


def _columns(keys: Sequence[Column | str]) -> list[Column]:
    return [T.col(k) for k in keys]


def best_row(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order (DD5-DD19, DD22-DD24). Null keys are a key of their own."""
    rank = F.row_number().over(Window.partitionBy(*_columns(keys)).orderBy(*_columns(order)))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def first_row(df: DataFrame, keys: Sequence[Column | str], position: Column | str = POSITION) -> DataFrame:
    """First come, first kept (DD1-DD4, DD16, DD17, DD21, DD25)."""
    return best_row(df, keys, [position])


def best_scored(df: DataFrame, keys: Sequence[Column | str], score: Column, *ties: Column | str, position: Column | str = POSITION) -> DataFrame:
    """Highest score, then ``ties``, then the position (DD6-DD12, DD14, DD18, DD23)."""
    return best_row(df, keys, [F.desc_nulls_last(score) if isinstance(score, str) else score.desc_nulls_last(), *ties, position])


def best_two_level(df: DataFrame, pair: Sequence[Column | str], single: Sequence[Column | str], score: Column, position: Column | str = POSITION) -> DataFrame:
    """Best per pair, then best per single key among those (DD5).

    With one score and one position, the best row of a single key is the best of its pairs' best rows: one window does both.
    """
    return best_scored(df, single, score, position=position)


def unique_pairs_plus_best(df: DataFrame, idiom: Column, meaning: Column, score: Column, position: Column | str = POSITION) -> DataFrame:
    """One row per (idiom, meaning) with a meaning, and one best row per idiom (DD13, ST6)."""
    p = T.col(position)
    pair = F.row_number().over(Window.partitionBy("__i", "__m").orderBy(F.desc("__s"), p))
    single = F.row_number().over(Window.partitionBy("__i").orderBy(F.desc("__s"), "__m", p))
    rows = df.withColumns({"__i": idiom, "__m": meaning, "__s": score}).withColumn("__pair", pair).where("__pair = 1")
    return rows.withColumn("__single", single).where((F.col("__m") != "") | (F.col("__single") == 1)).drop("__i", "__m", "__s", "__pair", "__single")


def by_priority(df: DataFrame, keys: Sequence[Column | str], column: str, order: Sequence[str], position: Column | str = POSITION) -> DataFrame:
    """The row whose ``column`` comes first in ``order``; unlisted values come last (DD15)."""
    rank = F.array_position(T.literals(order), F.col(column))
    return best_row(df, keys, [F.when(rank > 0, rank).otherwise(len(order) + 1), position])


def richest_row(df: DataFrame, keys: Sequence[Column | str], columns: Sequence[str], position: Column | str = POSITION) -> DataFrame:
    """The row with the most non-null values among ``columns`` (DD18)."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return best_scored(df, keys, filled, position=position)


def best_example_row(df: DataFrame, keys: Sequence[Column | str], example: str = "idiom_in_example", surface: str = "idiom_surface", position: Column | str = POSITION) -> DataFrame:
    """Non-empty example, the longer one, then a surface (DD19)."""
    e = T.safe(example)
    return best_row(df, keys, [F.desc(F.length(e)), F.desc((T.safe(surface) != "").cast("int")), position])


def exact_distinct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(DD3)"""
    return df.dropDuplicates(list(columns) if columns else df.columns)


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one (DD20)."""
    keys = list(columns) if columns else df.columns
    return df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"))
