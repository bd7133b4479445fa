"""Statistics: distributions, numeric summaries, audits and reports. Partial aggregates everywhere; nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phraseloom.functions import text as T


def filled(c: Column | str) -> Column:
    return T.safe(c) != ""


def core_statistics(df: DataFrame, idiom: str, meaning: str, example: str) -> DataFrame:
    """One row of counts, distincts and token averages (AG1, AG2, AG4, AG30, AG31, AG34)."""
    n = lambda c: T.token_count(c)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct(F.nullif(T.lower_norm(idiom), F.lit(""))).alias("unique_idioms"), F.count_distinct(F.nullif(T.lower_norm(meaning), F.lit(""))).alias("unique_meanings"),
        F.count_if(filled(meaning)).alias("rows_with_meaning"), F.count_if(filled(example)).alias("rows_with_example"),
        F.round(F.avg(n(idiom)), 4).alias("avg_idiom_tokens"), F.min(n(idiom)).alias("min_idiom_tokens"), F.max(n(idiom)).alias("max_idiom_tokens"),
        F.round(F.avg(F.when(filled(meaning), n(meaning))), 4).alias("avg_meaning_tokens"), F.round(F.avg(F.when(filled(example), n(example))), 4).alias("avg_example_tokens"))


def distribution(df: DataFrame, column: Column | str, missing: str | None = None, name: str = "value") -> DataFrame:
    """Counts of values; nulls as ``missing`` or, without it, left out (AG5, AG6, AG26)."""
    c = T.col(column)
    rows = df.select((F.coalesce(c.cast("string"), F.lit(missing)) if missing is not None else c).alias(name))
    return rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, column: Column | str, digits: int = 4, percent: bool = False) -> DataFrame:
    """Distribution with each value's share, or percentage (AG7, AG8). The window runs over distinct values."""
    found = distribution(df, column)
    return found.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * (100 if percent else 1), digits))


#: Rank error of the sketch that brackets a quantile, as a share of all rows, and half the width of the bracket.
SKETCH, BRACKET = 1e-5, 2e-5


def exact_quantiles(df: DataFrame, column: Column | str, shares: Sequence[float]) -> DataFrame:
    """One row: n, and the interpolated quantiles q0, q1, ... of the non-null values, null without any.

    A sketch brackets each quantile; the values are counted, pre-aggregated, and only the distinct values within a bracket,
    BRACKET of the ranks on either side, meet in one task, with the counts of what lies below.
    """
    values = df.select(T.col(column).cast("double").alias("v")).where("v is not null")
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    edges = [min(max(p + d, 0.0), 1.0) for p in shares for d in (-BRACKET, BRACKET)]
    marks = values.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", edges, int(1 / SKETCH)).alias("edges"))
    rows = counts.join(F.broadcast(marks))  # one row
    parts = []
    for k in range(len(shares)):
        lo, hi = F.get("edges", F.lit(2 * k)), F.get("edges", F.lit(2 * k + 1))
        parts += [F.sum(F.when(F.col("v") < lo, F.col("c")).otherwise(0)).alias(f"below{k}"), F.max(F.when(F.col("v") < lo, F.col("v"))).alias(f"prev{k}"), F.min(F.when(F.col("v") > hi, F.col("v"))).alias(f"next{k}")]
        parts.append(F.sort_array(F.collect_list(F.when((F.col("v") >= lo) & (F.col("v") <= hi), F.struct("v", "c")))).alias(f"inside{k}"))
    found = rows.agg(F.max("n").alias("n"), *parts)

    def at(k: int, rank: Column) -> Column:
        """The value of a rank from 0; by the sketch's error it may lie one beyond the bracket of a small table."""
        start = F.struct(F.col(f"below{k}").alias("run"), F.lit(None).cast("double").alias("v"))
        step = lambda acc, x: F.struct((acc["run"] + x["c"]).alias("run"), F.when((acc["run"] <= rank) & (rank < acc["run"] + x["c"]), x["v"]).otherwise(acc["v"]).alias("v"))
        inside = F.aggregate(f"inside{k}", start, step, lambda acc: acc["v"])
        return F.when(rank < F.col(f"below{k}"), F.col(f"prev{k}")).otherwise(F.coalesce(inside, F.col(f"next{k}")))

    out = []
    for k, p in enumerate(shares):
        place = F.lit(float(p)) * (F.col("n") - 1)
        low = F.floor(place)
        first, second = at(k, low), at(k, F.least(low + 1, F.col("n") - 1))
        out.append((first + (place - low) * (second - first)).alias(f"q{k}"))
    return found.select(F.coalesce("n", F.lit(0)).alias("n"), *out)


def numeric_summary(df: DataFrame, column: Column | str, digits: int = 4) -> DataFrame:
    """count, mean, std, min, p25, median, p75, max; a single value has std 0, no values give 0 throughout (AG9, AG22)."""
    x = T.col(column).cast("double")
    zero = lambda c: F.coalesce(F.round(c, digits), F.lit(0.0))
    plain = df.agg(F.count(x).alias("count"), zero(F.avg(x)).alias("mean"), zero(F.stddev_samp(x)).alias("std"), zero(F.min(x)).alias("min"), zero(F.max(x)).alias("max"))
    quantiles = exact_quantiles(df, column, (0.25, 0.5, 0.75)).select(*[zero(F.col(f"q{k}")).alias(name) for k, name in enumerate(("p25", "median", "p75"))])
    return plain.join(F.broadcast(quantiles)).select("count", "mean", "std", "min", "p25", "median", "p75", "max")  # one row each


def filled_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each column: rows, non-null, non-empty and distinct non-empty values (AG10), in one pass."""
    parts = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n"), F.count(c).alias("non_null"), F.count_if(filled(c)).alias("non_empty"), F.count_distinct(F.nullif(T.safe(c), F.lit(""))).alias("unique_non_empty")) for c in columns]
    return df.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """Null count and ratio of columns, in one pass (AG17, AG18)."""
    names = list(columns or df.columns)
    parts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"), T.safe_div(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias("ratio")) for c in names]
    out = df.agg(F.array(*parts).alias("x")).select(F.inline("x"))
    return out.where("nulls > 0") if only_missing else out


def per_group(df: DataFrame, key: str, counted: str, name: str = "n") -> DataFrame:
    """Distinct values of each key, nulls left out (AG14, AG23)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(counted).alias(name))


def rows_per(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows of each key, nulls left out (AG13, AG21)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def high_frequency(df: DataFrame, key: str, more_than: int = 100) -> DataFrame:
    """(AG21)"""
    return rows_per(df, key).where(F.col("n") > more_than)


def group_coverage(df: DataFrame, key: str = "idiom_id", row_type: str = "row_type") -> DataFrame:
    """Rows of each idiom: all, main and adversarial (AG15)."""
    kind = F.coalesce(F.col(row_type), F.lit(""))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(kind == "main_example").alias("main_rows"), F.count_if(F.startswith(kind, F.lit("adversarial"))).alias("adversarial_rows"))


def coverage_ratios(coverage: DataFrame, main: int = 12, adversarial: int = 2) -> DataFrame:
    """Groups short of main or adversarial rows, and their shares (AG16)."""
    n = F.count(F.lit(1))
    short = {"main": F.count_if(F.col("main_rows") < main), "adversarial": F.count_if(F.col("adversarial_rows") < adversarial)}
    return coverage.agg(n.alias("groups"), *[c.alias(f"incomplete_{k}") for k, c in short.items()], *[T.safe_div(c, n).alias(f"ratio_{k}") for k, c in short.items()])


def reuse_factor(df: DataFrame, column: Column | str) -> DataFrame:
    """Rows over distinct values (AG19)."""
    c = T.col(column)
    return df.agg(F.count(c).alias("n"), F.count_distinct(c).alias("unique"), T.safe_div(F.count(c), F.count_distinct(c), 2).alias("reuse"))


def most_frequent(df: DataFrame, column: Column | str) -> DataFrame:
    """The most frequent value, the smallest on ties (AG20)."""
    return distribution(df, column).orderBy(F.desc("n"), "value").limit(1)


def top_values(df: DataFrame, column: Column | str, n: int = 20) -> DataFrame:
    """(AG11, AG25, AG33: previews)"""
    return distribution(df, column).orderBy(F.desc("n"), "value").limit(n)


def overlap_counts(a: DataFrame, b: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sizes of the overlaps of two tables by named key tuples (AG27)."""
    parts = [a.select(*k).intersect(b.select(*k)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("overlap"), "n") for name, k in keys.items()]
    return reduce(DataFrame.unionByName, parts)


def proportion(df: DataFrame, masks: Mapping[str, Column], digits: int = 6) -> DataFrame:
    """Share of rows for which each mask holds (AG28)."""
    return df.agg(*[F.round(F.coalesce(F.avg(F.coalesce(m, F.lit(False)).cast("int")), F.lit(0.0)), digits).alias(name) for name, m in masks.items()])


def by_source(broad: DataFrame, high: DataFrame, source: str = "source") -> DataFrame:
    """Rows of each source in both sets (AG3)."""
    both = broad.select(F.col(source), F.lit(1).alias("b"), F.lit(0).alias("h")).unionAll(high.select(F.col(source), F.lit(0), F.lit(1)))
    return both.groupBy(source).agg(F.sum("b").alias("broad"), F.sum("h").alias("high"))


def retention(sizes: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named stage and their share of the first (AG35)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n") for i, (name, df) in enumerate(sizes.items())]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("retained", T.safe_div(F.col("n"), F.first("n").over(Window.orderBy("step"))))


def request_estimate(df: DataFrame, tokens_each: int = 300) -> DataFrame:
    """(AG29)"""
    return df.agg(F.count(F.lit(1)).alias("requests"), (F.count(F.lit(1)) * tokens_each).alias("tokens"))


def to_long(section: str, one_row: DataFrame) -> DataFrame:
    """A one-row table as (section, metric, value) (AG12)."""
    parts = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in one_row.columns]
    return one_row.select(F.lit(section).alias("section"), F.inline(F.array(*parts)))


def histogram(df: DataFrame, column: Column | str, low: float, high: float, bins: int = 50) -> DataFrame:
    """Counts of equal-width bins: the data of a chart (SNK8)."""
    return df.select(F.width_bucket(T.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).where("bin is not null").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def crawl_statistics(fetched: DataFrame, entries: DataFrame, key: str = "page_id", html: str = "html", term: str = "term", meaning: str = "meaning") -> DataFrame:
    """One row: pages asked for, fetched, failed and with entries; entries, those with a meaning, and distinct terms (AG31)."""
    pages = fetched.agg(F.count(F.lit(1)).alias("pages"), F.count(html).alias("fetched"), F.count_if(F.col(html).isNull()).alias("failed"))
    found = entries.agg(F.count_distinct(key).alias("pages_with_entries"), F.count(F.lit(1)).alias("entries"), F.count_if(T.safe(meaning) != "").alias("with_meaning"), F.count_distinct(T.lower_norm(term)).alias("unique_terms"))
    return pages.join(F.broadcast(found))  # one row each


def bars(df: DataFrame, column: Column | str) -> DataFrame:
    """Labels, counts and heights relative to the tallest: the data of a bar chart (SNK8)."""
    counts = df.groupBy(T.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n").alias("most"))  # one row
    return counts.join(F.broadcast(most)).select("label", "n", F.round(F.col("n") / F.col("most"), 4).alias("height"))


def full_report(df: DataFrame, core: tuple[str, str, str], distributions: Sequence[str], numbers: Mapping[str, Column]) -> DataFrame:
    """(section, metric, value): core counts, distributions, numeric summaries and missing values (AG11, AG12, AG32)."""
    parts = [to_long("core", core_statistics(df, *core))]
    parts += [distribution(df, c, "MISSING").select(F.lit(c).alias("section"), F.col("value").alias("metric"), F.col("n").cast("string").alias("value")) for c in distributions if c in df.columns]
    parts += [to_long(name, numeric_summary(df, c)) for name, c in numbers.items()]
    parts.append(null_audit(df).select(F.lit("missing").alias("section"), F.col("column").alias("metric"), F.col("nulls").cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)
