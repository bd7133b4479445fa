"""The per-line part of phrase mining on a stream: stateless, so that any file source and trigger will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phraseloom.functions import predicates as P
from phraseloom.functions import text as T


def read_line_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.text(folder)


def dialogue_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Normalised lines that are worth keeping (SC35, FLT18); works on streams and tables alike."""
    rows = T.once(lines.select(value), text=T.dialogue_line(value)).select("text")
    return rows.where(P.raw_dialogue_line("text", clean=True))


def phrase_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Running line counts of candidate phrases; for the complete output mode on a stream."""
    from phraseloom.operators.mining import ngrams

    tokens = F.regexp_extract_all(F.lower(F.col("text")), F.lit(T.WORD), F.lit(0))
    grams = F.array_distinct(F.transform(ngrams(tokens, 3, 5), lambda g: g["phrase"]))
    rows = dialogue_lines(lines, value).select(F.explode(grams).alias("phrase")).withColumn("tokens", F.split("phrase", " "))
    return rows.where(P.mining_phrase(F.col("phrase"), F.col("tokens"))).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
