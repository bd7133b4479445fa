"""Crawled pages: terms by tag and class, visible lines as a fallback, and links. Pages are parsed in Arrow batches; the rest is columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import predicates as P
from phraseloom.functions import text as T
from phraseloom.sources.dom import parsed_pages


def visible_text(html: Column | str) -> Column:
    """Text without scripts, styles, comments and tags; block ends become line breaks, common entities characters."""
    t = F.regexp_replace(F.coalesce(T.col(html), F.lit("")), r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(?:p|div|li|h[1-6]|tr|section|article|ul|ol|title)\s*>", "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return t


def class_entries(pages: DataFrame, terms: str = ".word, a.word, h1, h2", meanings: str = ".meaning", examples: str = ".example", key: str = "page_id", html: str = "html", requested: str | None = None) -> DataFrame:
    """(key, at, term, meaning, example): the elements' texts side by side, as many as there are both terms and meanings (SRC12).

    With ``requested``, the column of the term that a page was asked for, only that term stays, as a phrase with a meaning and
    without explicit text.
    """
    asked = ["__asked"] if requested else []
    found = parsed_pages(pages.select(key, *([F.col(requested).alias("__asked")] if requested else []), html), {"__terms": terms, "__meanings": meanings, "__examples": examples}, html)
    both = F.least(F.size("__terms"), F.size("__meanings"))
    zipped = F.slice(F.arrays_zip(F.col("__terms").alias("term"), F.col("__meanings").alias("meaning"), F.col("__examples").alias("example")), F.lit(1), both)
    rows = found.select(key, *asked, F.posexplode(zipped).alias("at", "e"))
    rows = rows.select(key, *asked, "at", T.norm("e.term").alias("term"), T.norm("e.meaning").alias("meaning"), T.norm("e.example").alias("example"))
    if requested:
        same = T.idiom_key("term") == T.idiom_key("__asked")
        rows = rows.where(same & P.good_phrase("term") & (F.col("meaning") != "") & ~P.explicit("meaning", "example", terms=L.PAGE_EXPLICIT))
        rows = rows.withColumn("term", T.idiom_key("term"))
    return rows.select(key, "at", "term", "meaning", "example")


def text_entries(
    pages: DataFrame, term: str = "term", skipped: tuple[str, ...] = L.PAGE_STOP_LINES, key: str = "page_id", html: str = "html"
) -> DataFrame:
    """(key, at, term, meaning, example) from the visible lines (SRC13).

    After a line that is the term, the lines up to an author's line, a footer or the term again are its entry, without those to skip: the first
    is the meaning, the second the example. Each such line of a page starts an entry, but for those within another one's
    lines; terms that are no phrase, entries without a meaning and those with explicit text give no row.
    """
    lines = F.filter(F.transform(F.flatten(F.transform("page_strings", lambda x: F.split(x, "\n"))), T.norm), lambda x: x != "")
    rows = parsed_pages(pages.select(key, F.col(term).alias("__term"), html), {}, html)
    rows = T.once(rows.select(key, T.idiom_key("__term").alias("term"), lines.alias("lines")), marks=F.transform("lines", T.idiom_key)).where(P.good_phrase("term"))
    # an entry is open after its term; it closes before an author's line or a footer, or at the term again once it has a line
    ends = lambda i: T.any_prefix(F.get("marks", i), ("by ",)) | T.any_prefix(F.get("lines", i), ("Get the ", "© "))
    none = F.array().cast("array<string>")
    entry = lambda x: F.struct(x.alias("lines"))

    def step(s: Column, i: Column) -> Column:
        is_term, stops, skip = F.get("marks", i) == F.col("term"), ends(i), F.get("marks", i).isin(*skipped)
        fresh = F.struct(F.lit(True).alias("open"), none.alias("held"), s["done"].alias("done"))
        closed = F.concat(s["done"], F.array(entry(s["held"])))
        again = F.struct(F.lit(True).alias("open"), none.alias("held"), closed.alias("done"))
        shut = F.struct(F.lit(False).alias("open"), none.alias("held"), closed.alias("done"))
        more = F.struct(F.lit(True).alias("open"), F.concat(s["held"], F.array(F.get("lines", i))).alias("held"), s["done"].alias("done"))
        opened = F.when(stops, shut).when(skip, s).when(is_term & (F.size(s["held"]) > 0), again).otherwise(more)
        return F.when(s["open"], opened).when(is_term, fresh).otherwise(s)

    start = F.struct(F.lit(False).alias("open"), none.alias("held"), F.array().cast("array<struct<lines:array<string>>>").alias("done"))
    finish = lambda s: F.when(s["open"], F.concat(s["done"], F.array(entry(s["held"])))).otherwise(s["done"])
    found = F.aggregate(F.sequence(F.lit(0), F.size("lines") - 1), start, step, finish)
    rows = rows.where(F.size("lines") > 0).select(key, "term", F.posexplode(found).alias("at", "e"))
    rows = rows.select(key, "at", "term", F.coalesce(F.get("e.lines", F.lit(0)), F.lit("")).alias("meaning"), F.coalesce(F.get("e.lines", F.lit(1)), F.lit("")).alias("example"))
    return rows.where((F.col("meaning") != "") & ~P.explicit("meaning", "example", terms=L.PAGE_EXPLICIT))


def page_entries(pages: DataFrame, term: str = "term", key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, at, term, meaning, example): entries by class, or by visible lines where a page has none (SRC12, SRC13)."""
    by_class = class_entries(pages, key=key, html=html, requested=term)
    rest = pages.join(by_class.select(key).distinct(), key, "left_anti")
    return by_class.unionByName(text_entries(rest, term, key=key, html=html))


def links(pages: DataFrame, parameter: str = "term", most: int = 20, key: str = "page_id", html: str = "html", own: str | None = None, path: str = "define.php?") -> DataFrame:
    """(key, at, term): terms of links to ``path`` that carry the parameter, decoded and normalised, phrases only, in order, distinct, without
    the page's own, at most ``most`` (SRC14)."""
    asked = [own] if own else []
    found = parsed_pages(pages.select(key, *asked, html), {}, html)
    fitting = F.filter("page_links", lambda x: F.contains(x, F.lit(f"{path}{parameter}=")) if path else F.contains(x, F.lit(f"{parameter}=")))
    query = lambda x: F.regexp_extract(x, rf"[?&]{parameter}=([^&#]*)", 1)
    decoded = lambda x: F.coalesce(F.try_url_decode(x), x)
    terms = F.filter(F.transform(fitting, lambda x: T.idiom_key(decoded(query(x)))), lambda x: P.good_phrase(x))
    if own:
        terms = F.filter(terms, lambda x: x != T.idiom_key(own))
    return found.select(key, F.posexplode(F.slice(F.array_distinct(terms), 1, most)).alias("at", "term"))


def all_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, at, url): every href, in order."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"""(?i)href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("at", "url"))
