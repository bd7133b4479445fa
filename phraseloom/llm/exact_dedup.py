"""Exact deduplication by progressive refinement: length, then prefix hash, then the full hash of what is left."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Characters of the normalised text that the second refinement hashes.
PREFIX_CHARS = 64
#: A key table is broadcast up to this many counted rows (32 bytes each at most); above it the join is shuffled.
BROADCAST_ROWS = 1_000_000


#: What the refinement knows of a row without its text: a hash of its id, the text's length and the hash of its prefix.
MARKS = ["place", "len", "prefix"]


@dataclass
class Groups:
    """Groups of two or more equal texts: ``sha`` (binary SHA-256), ``keep_id``, ``group_size``, ``keep_rows``."""

    table: DataFrame
    #: Some group holds its largest id more than once, so that the id alone doesn't name the row that stays.
    repeated_keeper: bool
    #: (id, place, len, prefix, sha) of the rows that the refinement has left: the only ones whose texts were hashed whole.
    survivors: DataFrame


def byte_length(text: Column) -> Column:
    # a translation of A-Z to a-z changes neither the bytes' number nor their places: lengths need no translation
    return F.octet_length(F.coalesce(text, F.lit("")))


def prefix_hash(text: Column) -> Column:
    return F.xxhash64(C.ascii_lower(F.substring(text, 1, PREFIX_CHARS)))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(C.ascii_lower(text), 256))


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with MARKS."""
    text = F.col(text_col)
    return docs.withColumns({"place": F.xxhash64(F.col(id_col).cast("string")), "len": byte_length(text), "prefix": prefix_hash(text)})


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Groups:
    """Find the groups of equal texts (equal after lower-casing A-Z; null counts as empty).

    Each pass looks at what the one before has left: rows whose length occurs again, of these the rows whose prefix hash occurs again, and of
    these the hash of the whole text. The first two read narrow rows without texts; texts meet the rows that are left once, by a
    key that holds the id, so that no group of copies meets in one task. Counts are pre-aggregated. A null id is smaller than any.
    """
    rows = marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    narrow = C.materialize(rows.select(*MARKS), "dedup-rows")
    lengths = C.materialize(narrow.groupBy("len").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len"), "dedup-lengths")
    again = C.join_small(narrow, lengths, "len", "left_semi", BROADCAST_ROWS)
    prefixes = C.materialize(again.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len", "prefix"), "dedup-prefixes")
    left = C.materialize(C.join_small(again, prefixes, ["len", "prefix"], "left_semi", BROADCAST_ROWS).distinct(), "dedup-left")
    survivors = C.join_small(rows, left, MARKS, "left_semi", BROADCAST_ROWS).select("id", *MARKS, digest(F.col("text")).alias("sha"))
    survivors = C.materialize(survivors, "dedup-survivors")
    each = survivors.groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n"))
    groups = each.groupBy("sha").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.max(F.struct(F.col("id"), F.col("n")))["n"].alias("keep_rows")).where("group_size > 1")
    groups = C.materialize(groups, "dedup-groups")
    repeated = groups.agg(F.max("keep_rows")).first()[0]
    return Groups(groups, bool(repeated and repeated > 1), survivors)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (hex of the normalised text).

    Of equal texts the row with the largest id stays; where that row itself is repeated, one of its copies does.
    A unique text keeps itself with group_size 1. Null ids count as smallest. The digest is a column of the result, so that here
    every text is hashed once more; drop_exact_copies hashes only what the refinement leaves.
    """
    groups = duplicate_groups(docs, id_col, text_col)
    hashed = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("sha"))
    found = groups.table.select(F.col("sha"), F.col("keep_id").alias("group_keep"), "group_size")
    rows = C.join_small(hashed, found, "sha", "left", BROADCAST_ROWS)
    single = F.col("group_size").isNull()
    out = rows.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("group_keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(F.col("group_keep"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    if groups.repeated_keeper:
        # identical rows: which of them stays can't matter, so one is chosen among the few that claim it
        n = F.row_number().over(Window.partitionBy("doc_id", "text_sha256", "kept").orderBy(F.lit(1)))
        out = out.withColumn("kept", F.col("kept") & (n == 1))
    return out


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies, columns unchanged, whatever their names: of equal texts the row with the largest id stays.

    A text that the refinement has not left passes without being hashed. Where the staying row is repeated, one of its copies passes.
    """
    held, back, (own_id, text) = C.renamed(docs, id_col, text_col)
    groups = duplicate_groups(held, own_id, text)
    of = C.join_small(groups.survivors, groups.table, "sha", "inner", BROADCAST_ROWS)
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    # of a row's marks: the digests that go, and those of rows that stay but are repeated (one digest, unless an id has several texts)
    verdicts = of.groupBy(*MARKS).agg(F.collect_set(F.when(~stays, F.col("sha"))).alias("gone"), F.collect_set(F.when(stays & (F.col("keep_rows") > 1), F.col("sha"))).alias("twice"))
    verdicts = C.materialize(verdicts.where("size(gone) > 0 or size(twice) > 0"), "dedup-verdicts")
    rows = C.join_small(marked(held, own_id, text), verdicts, MARKS, "left", BROADCAST_ROWS)
    rows = rows.withColumn("sha", F.when(F.col("gone").isNotNull(), digest(F.col(text))))
    rows = rows.where(F.col("gone").isNull() | ~F.array_contains("gone", F.col("sha")))
    if groups.repeated_keeper:
        again = F.coalesce(F.array_contains("twice", F.col("sha")), F.lit(False))
        rows = rows.where(~again).unionByName(rows.where(again).dropDuplicates([*MARKS, "sha"]))
    return back(rows)
