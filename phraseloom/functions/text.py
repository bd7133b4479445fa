"""Text functions. All take Columns and yield Columns; null text is the empty text unless the docstring says otherwise.

White space and word characters are Unicode's ((?U) in Java's patterns), as users of Unicode text expect.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from phraseloom.shipping import ship

SPACES = r"(?U)\s+"
#: Unicode's white space as characters, for trimming.
WHITE_CHARS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: The runs that collapsing changes: single blanks, nearly all white space, are no match.
UNEVEN_SPACES = r"(?U)[^\S ]\s*| \s+"
NO_SPACES = r"(?U)\S+"
BAD_SYMBOLS = r"[<>\[\]{}_=+*/\\|]"
#: The older filters allow the vertical bar.
BAD_SYMBOLS_NO_BAR = r"[<>\[\]{}_=+*/\\]"
BAD_CHARS = r"[<>\[\]{}=_*\\|]"
WORD = r"[A-Za-z]+(?:'[A-Za-z]+)?"
WORD_OR_NUMBER = r"[A-Za-z0-9]+(?:'[A-Za-z0-9]+)?"
TIMESTAMPS = r"\b\d{1,2}:\d{2}(?::\d{2})?(?:,\d{1,3})?\s*-->\s*\d{1,2}:\d{2}(?::\d{2})?(?:,\d{1,3})?\b"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once per row, however often the body mentions it.

    Catalyst inlines projected expressions wherever they are mentioned; a lambda's variable is bound instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df, **columns: Column):
    """``df`` with columns that are computed once per row, however often later filters and projections mention them.

    They are generated (an array of one struct is unfolded): nothing is inlined into what stands above a generator.
    """
    rows = df.select(*[c for c in df.columns if c not in columns], F.explode(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))).alias("__once"))
    return rows.select(*[c for c in rows.columns if c != "__once"], *[F.col("__once")[k].alias(k) for k in columns])


def safe(c: Column | str) -> Column:
    """Null becomes '', white space around is trimmed (SC1)."""
    return F.btrim(F.coalesce(col(c).cast("string"), F.lit("")), F.lit(WHITE_CHARS))


def norm(c: Column | str) -> Column:
    """safe, and inner white space runs become one blank (SC1)."""
    return F.trim(F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), UNEVEN_SPACES, " "))


def lower_norm(c: Column | str) -> Column:
    return F.lower(norm(c))


def idiom_key(c: Column | str) -> Column:
    """lower_norm with the curly apostrophe straightened (SC2)."""
    return F.translate(lower_norm(c), "’", "'")


def example_key(c: Column | str) -> Column:
    """idiom_key without straight and curly double quotes and backticks (SC3)."""
    return norm(F.regexp_replace(idiom_key(c), '["“”`]+', ""))


def example_normalized(c: Column | str) -> Column:
    """Lower case, non-word characters deleted, blanks collapsed (SC4)."""
    return norm(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"(?U)[^\w\s]", ""))


def equality_normalized(c: Column | str) -> Column:
    """As example_normalized, but non-word characters become blanks (SC5)."""
    return norm(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"(?U)[^\w\s]", " "))


def tidy_example(c: Column | str) -> Column:
    """Curly quotes straightened, blanks collapsed and removed before punctuation (SC6)."""
    straight = F.translate(F.coalesce(col(c), F.lit("")), "“”‘’", "\"\"''")
    return norm(F.regexp_replace(F.regexp_replace(straight, UNEVEN_SPACES, " "), r"\s+([,.!?;:])", "$1"))


def tokens(c: Column | str) -> Column:
    """White-space tokens; an empty text has none."""
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(NO_SPACES), F.lit(0))


def token_count(c: Column | str) -> Column:
    """(SC7)"""
    return word_count(c)


def word_count(c: Column | str) -> Column:
    """Runs of non-space characters (SC8)."""
    return F.regexp_count(F.coalesce(col(c), F.lit("")), F.lit(NO_SPACES))


def words(c: Column | str) -> Column:
    """Lower-case letter words with contractions (SC9)."""
    return F.regexp_extract_all(idiom_key(c), F.lit(WORD), F.lit(0))


def word_set(c: Column | str) -> Column:
    """Distinct lower-case words and numbers (SC10)."""
    return F.array_distinct(F.regexp_extract_all(idiom_key(c), F.lit(WORD_OR_NUMBER), F.lit(0)))


def unicode_words(c: Column | str) -> Column:
    """Distinct lower-case runs of word characters (SC11)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0)))


def literals(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def without(tokens_: Column, stopwords: Iterable[str]) -> Column:
    """Content words: tokens outside the set, repeats kept (SC12)."""
    stop = sorted(stopwords)  # a set of literals is hashed, an array of them would be searched
    return F.filter(tokens_, lambda t: ~t.isin(*stop))


def tag_list(c: Column | str) -> Column:
    """Comma-separated tags as an ordered distinct array (SC13)."""
    parts = F.transform(F.split(F.lower(safe(c)), ","), lambda t: norm(t))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def merge_tags(*arrays: Column, separator: str = ",") -> Column:
    """Ordered distinct union of tag arrays, joined (SC14, SC15)."""
    both = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    clean = F.filter(F.transform(both, lambda t: lower_norm(t)), lambda t: t != "")
    return F.array_join(F.array_distinct(clean), separator)


def first_nonempty(*arrays: Column) -> Column:
    """The first non-empty normalised item of several arrays, else '' (SC16, SC17)."""
    both = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    return F.coalesce(F.get(F.filter(F.transform(both, norm), lambda t: t != ""), F.lit(0)), F.lit(""))


def any_in(text: Column, hints: Iterable[str]) -> Column:
    """Substring test for any of the hints."""
    found = F.lit(False)
    for h in hints:
        found = found | F.contains(text, F.lit(h))
    return found


def any_word_in(text: Column, hints: Iterable[str]) -> Column:
    """As any_in, but only where the hint stands as a word."""
    return F.rlike(text, F.lit(r"\b(?:" + "|".join(sorted(hints)) + r")\b"))


def any_prefix(text: Column, prefixes: Iterable[str]) -> Column:
    return F.rlike(text, F.lit("^(?:" + "|".join(re.escape(p) for p in prefixes) + ")"))


def any_match(text: Column, patterns: Iterable[str]) -> Column:
    """Search for any of several patterns, as one alternation."""
    return F.rlike(text, F.lit("|".join(f"(?:{p})" for p in patterns)))


def has_letters(c: Column) -> Column:
    return F.rlike(c, F.lit("[A-Za-z]"))


def is_upper(c: Column) -> Column:
    """Cased and without lower-case letters."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def dialogue_line(c: Column | str) -> Column:
    """Subtitle line without timestamps, bracketed noise, speaker prefix, leading dash and curly quotes (SC35).

    Lines of digits or of a time alone become ''. The order of the steps matters.
    """
    t = norm(c)
    t = F.regexp_replace(t, TIMESTAMPS, " ")
    t = F.regexp_replace(t, r"\[(.*?)\]|\((.*?)\)|\{(.*?)\}", " ")
    t = F.regexp_replace(t, r"^\s*[A-Z][A-Z0-9 _-]{1,25}:\s+", "")
    t = F.regexp_replace(t, r"^\s*[-–—]+\s*", "")
    t = norm(F.translate(t, "“”’‘", "\"\"''"))
    # a line of digits or of a time alone is replaced as a whole
    return F.regexp_replace(t, r"^(?:\d+|\d{1,2}:\d{2}(?::\d{2})?(?:,\d{1,3})?)$", "")


def slug(c: Column | str) -> Column:
    """White space runs as underscores (SC56)."""
    return F.regexp_replace(safe(c), SPACES, "_")


def dedup_key(*parts: Column | str) -> Column:
    """Normalised parts joined with ' || ' (SC62); never null."""
    return F.concat_ws(" || ", *[lower_norm(p) for p in parts])


def short_id(prefix: str, *parts: Column | str, length: int = 12, separator: str = " || ", lower: bool = True) -> Column:
    """Stable id from an md5 of the joined parts (SC19, SC20)."""
    clean = [lower_norm(p) if lower else safe(p) for p in parts]
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws(separator, *clean).cast("binary")), 1, length))


def page_url(base: str, c: Column | str) -> Column:
    """URL with the term quoted, blanks as %20 and slashes kept (SC55); '' for an empty term."""
    t = F.translate(norm(c), "’", "'")
    quoted = F.replace(F.replace(F.url_encode(t), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    return F.when(t == "", F.lit("")).otherwise(F.concat(F.lit(base), quoted))


def lookup(c: Column, mapping: dict, default=None) -> Column:
    """Value of a small fixed mapping; unmapped keys give ``default`` (SC21, SC22)."""
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def nullable_bool(c: Column | str) -> Column:
    """true/1/yes and false/0/no in any case; everything else is null (SC45)."""
    t = F.lower(safe(c))
    return F.when(t.isin("true", "1", "yes", "1.0"), True).when(t.isin("false", "0", "no", "0.0"), False)


def label_bool(c: Column | str, borderline: bool | None = None) -> Column:
    """idiomatic -> true, literal -> false, borderline -> the given value, else null (SC44, SC61)."""
    t = F.lower(safe(c))
    return F.when(t == "idiomatic", True).when(t == "literal", False).when(t == "borderline", F.lit(borderline).cast("boolean"))


def blank_to_null(c: Column | str, blanks: Iterable[str] = ("", "nan", "None")) -> Column:
    """(PRJ14)"""
    return F.when(col(c).isin(*blanks), None).otherwise(col(c))


def safe_div(a: Column, b: Column, digits: int = 6) -> Column:
    """Rounded quotient, 0 for a zero or null divisor (SC58)."""
    return F.coalesce(F.round(F.try_divide(a, b), digits), F.lit(0.0))


def surface(surface_col: Column | str, idiom_col: Column | str) -> Column:
    """The surface form, or the idiom where there is none (SC57)."""
    return F.coalesce(F.nullif(safe(surface_col), F.lit("")), col(idiom_col))


def json_list(c: Column | str) -> Column:
    """JSON array of strings; a JSON scalar or other text becomes a one-item list, null and '' an empty one (SC43)."""
    t = safe(c)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.from_json(t, "array<string>", {"mode": "PERMISSIVE"}), F.array(t)))


def json_salvage(c: Column | str, kind: str = "object") -> Column:
    """The text if it is JSON of the kind, else its greedy {...} or [...] part if that is, else null (SC40)."""
    opening, pattern = ("{", r"(?s)\{.*\}") if kind == "object" else ("[", r"(?s)\[.*\]")
    valid = lambda x: F.when(F.startswith(x, F.lit(opening)) & F.try_parse_json(x).isNotNull(), x)
    return let(safe(c), lambda t: F.coalesce(valid(t), let(F.regexp_extract(t, pattern, 0), valid)))


def json_read(c: Column, kind: str = "object") -> Column:
    """JSON of what a tolerant reader finds in a text from the first bracket on, null if there is nothing in it; null texts are not looked at."""
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        from phraseloom.functions.repair import repaired

        return texts.map(lambda t: repaired(t, "{" if kind == "object" else "["), na_action="ignore").astype(object)

    return read(c)


def json_repaired(c: Column | str, kind: str = "object") -> Column:
    """json_salvage, else what a tolerant reader finds from the first bracket on, if there is anything in it (UD15).

    Single or curly quotes, bare keys and words, words of Python, missing and trailing commas, comments, quotes within strings and all
    that was left open are read. Only texts that are not JSON reach Python. (The text is salvaged twice: see with_json.)
    """
    whole = json_salvage(c, kind)
    return F.coalesce(whole, json_read(F.when(whole.isNull(), safe(c)), kind))


def with_json(df, c: Column | str, name: str, kind: str = "object"):
    """``df`` with json_repaired of a text, which is salvaged once for each row."""
    rows = once(df, __text=safe(c))
    rows = once(rows, __whole=json_salvage("__text", kind))
    rows = rows.withColumn("__text", F.when(F.col("__whole").isNull(), F.col("__text")))
    return rows.withColumn(name, F.coalesce("__whole", json_read(F.col("__text"), kind))).drop("__text", "__whole")
