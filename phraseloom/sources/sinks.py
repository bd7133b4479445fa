"""Writers. Each writes a folder by Spark's commit protocol; none deletes anything it did not just replace."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """White space around values is kept (SNK1)."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """(SNK2)"""
    df.write.mode(mode).parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_both(df: DataFrame, csv_path: str, jsonl_path: str, mode: str = "error") -> None:
    """CSV and JSON lines of the same rows, computed once (SNK3)."""
    df = df.persist()
    try:
        write_csv(df, csv_path, mode)
        write_json_lines(df, jsonl_path, mode)
    finally:
        df.unpersist()


def write_report(one_row: DataFrame, path: str, mode: str = "error") -> None:
    """A one-row table as a JSON text (SNK4)."""
    one_row.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode(mode).text(path)


def write_requests(requests: DataFrame, path: str, mode: str = "error") -> None:
    """Request lines (SNK5)."""
    requests.select("value").write.mode(mode).text(path)


def write_list(df: DataFrame, column: str, path: str, mode: str = "error") -> None:
    """One value per line, distinct and sorted (SNK6)."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").write.mode(mode).text(path)


def markdown(long_report: DataFrame, title: str) -> DataFrame:
    """A (section, metric, value) report as Markdown lines, one per row in order (SNK7)."""
    head = long_report.select("section").distinct().select("section", F.lit(0).alias("k"), F.lit("").alias("metric"), F.concat(F.lit("\n## "), "section", F.lit("\n\n| metric | value |\n|---|---|")).alias("line"))
    body = long_report.select("section", F.lit(1).alias("k"), "metric", F.concat(F.lit("| "), "metric", F.lit(" | "), F.coalesce("value", F.lit("")), F.lit(" |")).alias("line"))
    first = long_report.sparkSession.createDataFrame([("", -1, "", f"# {title}")], "section string, k int, metric string, line string")
    return first.unionByName(head).unionByName(body).orderBy("section", "k", "metric").select("line")


def publish(tables: Mapping[str, DataFrame], folder: str, mode: str = "error") -> None:
    """Every named table as Parquet and CSV (SNK9)."""
    for name, df in tables.items():
        write_parquet(df, f"{folder}/{name}.parquet", mode)
        write_csv(df, f"{folder}/{name}.csv", mode)


def checkpoint_stage(df: DataFrame, path: str) -> DataFrame:
    """A stage written once and read back; a rerun finds and keeps it (SNK10)."""
    from phraseloom.sources.readers import exists

    if not exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
