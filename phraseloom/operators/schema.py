"""Projection and schema operators: columns added, renamed, aligned and put in order. All are single selects."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import text as T

SOURCE_COLUMNS = ("idiom", "meaning_en", "example", "source", "source_type", "pos", "tags", "idiom_confidence", "source_url")
PRE_ENRICHMENT_COLUMNS = ("idiom_id", "idiom_canonical", "idiom_surface", "example", "idiom_canonical_meaning", "source", "source_type", "pos", "tags", "idiom_confidence", "source_url", "record_origin", "license_source", "example_language", "meaning_language")


def ensure_columns(df: DataFrame, columns: Sequence[str] | Mapping[str, object], fill: object = "") -> DataFrame:
    """Missing columns are added with a fill value, or each with its own default (PRJ2, PRJ8, PRJ17)."""
    defaults = dict(columns) if isinstance(columns, Mapping) else dict.fromkeys(columns, fill)
    missing = {c: F.lit(v) if v is not None else F.lit(None).cast("string") for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def normalize_columns(df: DataFrame, columns: Sequence[str], how: Callable[[str], Column] = T.norm) -> DataFrame:
    """(PRJ3)"""
    return df.withColumns({c: how(c) for c in columns if c in df.columns})


def normalize_source(df: DataFrame, normalizers: Mapping[str, Callable[[str], Column]] | None = None) -> DataFrame:
    """The nine source columns, created where missing, as clean texts (PRJ19)."""
    own = normalizers or {}
    return ensure_columns(df, SOURCE_COLUMNS).withColumns({c: own.get(c, T.norm)(c) for c in SOURCE_COLUMNS})


def reorder(df: DataFrame, preferred: Sequence[str], only: bool = False) -> DataFrame:
    """Preferred columns first, then the rest (PRJ5)."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *([] if only else [c for c in df.columns if c not in first]))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """(PRJ4)"""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def resolve(df: DataFrame, *candidates: str) -> str | None:
    """The first candidate name that is a column (PRJ6)."""
    return next((c for c in candidates if c in df.columns), None)


def to_source_schema(df: DataFrame, source: str, source_type: str, confidence: str, meaning: str = "meaning", keep: Sequence[str] = ()) -> DataFrame:
    """The common source schema with constants (PRJ1); ``keep`` names columns that stay after it."""
    out = df.withColumnRenamed(meaning, "meaning_en").withColumns({"source": F.lit(source), "source_type": F.lit(source_type), "idiom_confidence": F.lit(confidence)})
    return reorder(ensure_columns(out, SOURCE_COLUMNS), (*SOURCE_COLUMNS, *keep), only=True)


def comparison_view(df: DataFrame, idiom: str, meaning: str, example: str, position: str = "_pos") -> DataFrame:
    """(PRJ7)"""
    return df.withColumns({"_idiom_cmp": T.idiom_key(idiom), "_meaning_cmp": T.idiom_key(meaning), "_example_cmp": T.example_key(example), "_row_id_cmp": F.col(position)})


def align_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union all by name; columns of one side only are null on the other (PRJ9, ST1, ST7)."""
    return a.unionByName(b, allowMissingColumns=True)


def align_to(df: DataFrame, target: Sequence[str], names: Mapping[str, str] | None = None, constants: Mapping[str, object] | None = None) -> DataFrame:
    """Rename, fill constants, add nulls and select the target's columns (PRJ10, PRJ18, PRJ20)."""
    out = rename(df, names or {})
    own = constants or {}
    return out.select(*[F.lit(own[c]).alias(c) if c in own and c not in out.columns else F.coalesce(F.col(c), F.lit(own[c])).alias(c) if c in own else F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in target])


def promote_example(df: DataFrame, example: str = "example", used: str = "idiom_in_example") -> DataFrame:
    """The source's example becomes ``example_raw``, the generated one ``example`` (PRJ11)."""
    return df.withColumnsRenamed({example: "example_raw"}).withColumnsRenamed({used: "example"})


def reserve_example(df: DataFrame, example: str = "example") -> DataFrame:
    """``example`` moves to ``example_raw`` (kept where that is filled) and becomes '' (PRJ12)."""
    raw = F.coalesce(F.nullif(T.safe("example_raw"), F.lit("")), F.col(example)) if "example_raw" in df.columns else F.col(example)
    return df.withColumn("example_raw", raw).withColumn(example, F.lit(""))


def coerce_types(df: DataFrame, numeric: Sequence[str] = (), boolean: Sequence[str] = (), text: Sequence[str] = ()) -> DataFrame:
    """Numbers by try_cast, booleans from any spelling, texts with blanks and '<NA>' as null (PRJ13)."""
    out = {c: F.col(c).try_cast("double") for c in numeric}
    out |= {c: T.nullable_bool(c) for c in boolean}
    out |= {c: T.blank_to_null(F.col(c).cast("string"), ("", "nan", "None", "<NA>")) for c in text}
    return df.withColumns(out)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """'' and spelled-out nulls become null in every string column (PRJ14)."""
    return df.withColumns({c: T.blank_to_null(c) for c, kind in df.dtypes if kind == "string"})


def schema_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Shared, left-only and right-only column names (PRJ15, ST4)."""
    return {"shared": sorted(set(a.columns) & set(b.columns)), "left_only": sorted(set(a.columns) - set(b.columns)), "right_only": sorted(set(b.columns) - set(a.columns))}


def schema_contents(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, column, n): shared and one-sided columns of two tables and how many values they hold, those of both tables where shared (PRJ15, ST4)."""
    sides = {c: side for side, columns in schema_diff(left, right).items() for c in columns}
    counts = lambda df: df.agg(*[F.count(c).alias(c) for c in df.columns]).select(F.inline(F.array(*[F.struct(F.lit(sides[c]).alias("side"), F.lit(c).alias("column"), F.col(c).alias("n")) for c in df.columns])))
    return counts(left).unionByName(counts(right)).groupBy("side", "column").agg(F.sum("n").alias("n"))



def mark_adversarial(df: DataFrame, row_type: str = "row_type") -> DataFrame:
    """(PRJ16)"""
    return df.withColumn("is_adversarial", F.contains(F.lower(F.coalesce(F.col(row_type), F.lit(""))), F.lit("adversarial")))
