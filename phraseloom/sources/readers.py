"""Readers: dictionary dumps, text lines, tables by suffix or first existing path, and inventories.

Positions (``_pos``) come from the input's own key, or from file name and row index, never from a task's counter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phraseloom.functions import predicates as P
from phraseloom.functions import text as T
from phraseloom.sources.quoted import OPTIONS, read_quoted_csv

ENTRY = "word string, lang string, pos string, wiktionary_url string, senses array<struct<tags:array<string>, topics:array<string>, glosses:array<string>, raw_glosses:array<string>, examples:array<variant>>>"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system exists."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, *paths: str) -> str:
    """(SRC7, SRC8)"""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {', '.join(paths)} exists")


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header, quoted line breaks and an optional byte-order mark (SRC3), as many tasks as it has splits. Only '' is null."""
    return read_quoted_csv(spark, path, schema)


def spread(df: DataFrame, bytes_per_task: int = 4 << 20) -> DataFrame:
    """A small input dealt out to all cores; one of more than ``bytes_per_task`` for each core keeps its splits.

    A file of one row group is one task however many cores are idle. What Spark estimates of the input's size decides, so that nothing
    large is ever shuffled for this.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= bytes_per_task * cores else df


def dealt(df: DataFrame, rows_per_task: int = 20_000) -> DataFrame:
    """Narrow rows dealt out for work that is heavy for each of them: to all cores, and to no task more than ``rows_per_task``.

    A file's bytes say little of such work: millions of narrow rows may be one row group, which is one task. The rows of a file are counted
    by its footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows_per_task)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """(SRC4, SRC16)"""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """By suffix (SRC6)."""
    if path.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path)
    if path.endswith(".csv"):
        return read_csv(spark, path)
    raise ValueError(f"neither .parquet nor .csv: {path}")


def peek(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """(SRC17)"""
    head = spark.read.options(**OPTIONS).option("header", True).csv(path)  # the first records of a file, without the rest
    return head.withColumnsRenamed({c: c.lstrip("﻿") for c in head.columns}).limit(n)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of .txt or .gz files: text, file, row (from 0 within the file) and ``_pos``, their struct, which orders all lines (SRC5).

    Other suffixes are rejected; bytes that are no UTF-8 become replacement characters. Row numbers come from the number of lines
    in the file's blocks before, counted in a first pass, and the line's place in its block: no line is shuffled.
    """
    if not path.rstrip("*").endswith((".txt", ".gz", "/")):
        raise ValueError(f"neither .txt nor .gz: {path}")
    at = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), at.alias("at"))
    # one row for each block of a file
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    rows = lines.join(blocks, ["file", "block"]).withColumn("row", F.col("at") + F.col("shift"))
    return rows.select("text", "file", "row", F.struct("file", "row").alias("_pos"))


def read_json_lines(spark: SparkSession, path: str, schema: str = ENTRY) -> DataFrame:
    """JSON lines with ``parsed``; blank lines are skipped, broken ones kept as not parsed (SRC1, SRC2)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return parse_json_lines(lines, schema)


def parse_json_lines(lines: DataFrame, schema: str = ENTRY, value: str = "value") -> DataFrame:
    ok = F.try_parse_json(value).isNotNull()
    return lines.select(*[c for c in lines.columns if c != value], F.when(ok, F.from_json(value, schema)).alias("entry"), ok.alias("parsed"))


def line_counts(parsed: DataFrame) -> DataFrame:
    """Lines and parsed lines (SRC1, SRC2)."""
    return parsed.agg(F.count(F.lit(1)).alias("lines"), F.count_if("parsed").alias("parsed"))


def example_text(examples: Column) -> Column:
    """The first non-empty example of items that are texts or objects with a ``text`` (SC17)."""
    texts = F.transform(F.coalesce(examples, F.array().cast("array<variant>")), lambda v: F.coalesce(F.try_variant_get(v, "$.text", "string"), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))))
    return T.first_nonempty(texts)


def dictionary_senses(entries: DataFrame, language: str | None = "English", strict: bool = False) -> DataFrame:
    """Sense rows of dictionary entries with ``sense_index``, which counts skipped senses too (UD1, FLT1-FLT3, SC16-SC18).

    ``strict`` keeps senses with an idiom hint only.
    """
    e = F.col("entry")
    rows = entries.where("parsed").where(P.english_phrase(e["word"]))
    if language:
        rows = rows.where(P.language_is(e["lang"], language))
    keep = [c for c in entries.columns if c not in ("entry", "parsed")]
    rows = rows.select(*keep, T.norm(e["word"]).alias("idiom"), T.norm(e["pos"]).alias("pos"), e["wiktionary_url"].alias("source_url"), F.posexplode(e["senses"]).alias("sense_index", "s"))
    s = F.col("s")
    meaning = T.first_nonempty(s["glosses"], s["raw_glosses"])
    bag = F.lower(F.concat_ws(" ", F.coalesce(s["tags"], F.array().cast("array<string>")), F.coalesce(s["glosses"], F.array().cast("array<string>")), F.coalesce(s["raw_glosses"], F.array().cast("array<string>"))))
    from phraseloom.functions.lexicon import ENTRY_HINTS

    rows = rows.select(*keep, "idiom", meaning.alias("meaning"), example_text(s["examples"]).alias("example"), "pos", F.array_join(F.coalesce(s["tags"], F.array().cast("array<string>")), ", ").alias("tags"), T.any_in(bag, ENTRY_HINTS).cast("int").alias("idiom_hint"), F.lit("kaikki_wiktionary").alias("source"), "sense_index", "source_url")
    rows = rows.where(P.useful_sense("meaning"))
    return rows.where("idiom_hint = 1") if strict else rows


def slang_senses(entries: DataFrame) -> DataFrame:
    """Slang rows of dictionary entries, whatever their language tag (UD2, FLT15, SC14, SC55)."""
    e = F.col("entry")
    keep = [c for c in entries.columns if c not in ("entry", "parsed")]
    rows = entries.where("parsed").select(*keep, T.idiom_key(e["word"]).alias("idiom"), e["word"].alias("word"), F.lower(T.norm(e["pos"])).alias("pos"), F.posexplode(e["senses"]).alias("sense_index", "s"))
    s = F.col("s")
    meaning = T.first_nonempty(s["glosses"], s["raw_glosses"])
    rows = rows.where(P.slang_entry(F.col("word"), F.col("pos"), s["tags"], meaning) & P.slang_signal(s["tags"], s["topics"], meaning, s["raw_glosses"], F.col("pos")))
    return rows.select(*keep, "idiom", meaning.alias("meaning_en"), example_text(s["examples"]).alias("example"), F.lit("wiktionary_slang_kaikki").alias("source"), F.lit("dictionary").alias("source_type"), "pos", T.merge_tags(s["tags"], s["topics"]).alias("tags"), F.lit("medium").alias("idiom_confidence"), T.page_url("https://en.wiktionary.org/wiki/", "word").alias("source_url"), "sense_index")


def read_lexical_database(spark: SparkSession, path: str) -> DataFrame:
    """Synsets of a lexical database's data files: (definition, pos, lemmas), one line each, the licence's indented lines left out (SRC10).

    A line is ``offset file type count word id word id ... | gloss`` with the count in hexadecimal; quoted parts of the gloss are
    examples, the others the definition.
    """
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("  ")) & (F.trim("value") != ""))
    head, gloss = F.split(F.substring_index("value", " | ", 1), " "), F.trim(F.substring_index("value", " | ", -1))
    words = F.conv(F.get(head, F.lit(3)), 16, 10).cast("int")
    lemmas = F.transform(F.sequence(F.lit(0), words - 1), lambda i: F.regexp_replace(F.get(head, i * 2 + 4), r"\((?:a|p|ip)\)$", ""))
    parts = F.filter(F.transform(F.split(gloss, ";"), lambda x: F.trim(x)), lambda x: (x != "") & ~F.startswith(x, F.lit('"')))
    return lines.select(F.array_join(parts, "; ").alias("definition"), F.get(head, F.lit(2)).alias("pos"), lemmas.alias("lemmas"))


def lexical_entries(synsets: DataFrame) -> DataFrame:
    """Multiword lemmas of (definition, pos, lemmas array): underscores as blanks, lower case (SRC10)."""
    rows = synsets.select("definition", "pos", F.explode("lemmas").alias("lemma"))
    idiom = F.lower(F.translate("lemma", "_", " "))
    return rows.select(idiom.alias("idiom"), F.col("definition").alias("meaning_en"), "pos").where(F.contains("idiom", F.lit(" ")))


def read_inventory(spark: SparkSession, path: str, column: str = "idiom_canonical") -> DataFrame:
    """Normalised distinct idioms of a text, CSV or Parquet file, sorted (SRC11)."""
    if path.endswith(".txt"):
        values = spark.read.text(path).select(F.col("value").alias(column))
    else:
        values = read_any(spark, path)
    return inventory(values, column)


def inventory(df: DataFrame, column: str = "idiom_canonical") -> DataFrame:
    """(SRC11, SNK6)"""
    return df.select(T.idiom_key(column).alias(column)).where(F.col(column) != "").distinct().orderBy(column)


def read_rounds(spark: SparkSession, paths: Sequence[str], column: str = "idiom_canonical") -> DataFrame:
    """Round files with ``source_file``, those without the column left out, first file first (SRC9)."""
    kept = [df for df in (read_any(spark, p).withColumn("source_file", F.lit(p.rsplit("/", 1)[-1])) for p in paths) if column in df.columns]
    if not kept:
        raise ValueError(f"no file has a column {column}")
    out = kept[0]
    for df in kept[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def seed_terms(terms: DataFrame, column: str = "term") -> DataFrame:
    """Normalised seed phrases of two to eight words, distinct and sorted (SRC15)."""
    return terms.select(T.idiom_key(column).alias("term")).where(P.good_phrase("term")).distinct().orderBy("term")


def seeds(spark: SparkSession, path: str | None = None, default: Sequence[str] = ("break a leg", "spill the beans")) -> DataFrame:
    """Seed phrases of a text file with one in each line, or the default list where there is no file (SRC15)."""
    given = path is not None and exists(spark, path)
    return seed_terms(spark.read.text(path).withColumnRenamed("value", "term") if given else spark.createDataFrame([(t,) for t in default], "term string"))


def split_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines of documents with an id that keeps their order: (key, line_no, line_id, text)."""
    rows = docs.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "text"))
    return rows.select(key, "line_no", F.struct(key, "line_no").alias("line_id"), "text")
