"""Similarity of texts and vectors."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

#: English stopwords of the TF-IDF measure. Pass the list of the vectoriser that scores must agree with.
SHORT_STOPWORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will", "with")


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets: 1 if both are empty, 0 if one is (SC37)."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio (SC38): the only measure without a built-in, Arrow-batched."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, s or "", t or "").ratio() for s, t in zip(x, y, strict=True)], dtype=float)

    return ratio(a, b)


def surely_near(a: Column | str, b: Column | str, least_jaccard: float = 0.85) -> Column:
    """The part of near-duplicate meanings that needs no Python: equal, or token sets at least so similar (SC39)."""
    x, y = T.idiom_key(a), T.idiom_key(b)
    return (x != "") & (y != "") & ((x == y) | (jaccard(T.word_set(a), T.word_set(b)) >= least_jaccard))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Of two numeric arrays (SC51); a zero vector gives 0, null or unequal lengths give null."""
    x, y = T.col(a).cast("array<double>"), T.col(b).cast("array<double>")
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: u * v), F.lit(0.0), lambda s, u: s + u)
    norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(F.size(x) != F.size(y), None).when(norms == 0, 0.0).otherwise(dot(x, y) / norms)


def tfidf_terms(c: Column | str, stopwords: Iterable[str] = SHORT_STOPWORDS) -> Column:
    """Words of two or more characters outside the stopwords, and their bigrams."""
    found = T.without(F.regexp_extract_all(F.lower(F.coalesce(T.col(c), F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0)), stopwords)
    pair = lambda w, v: F.concat_ws(" ", w, v)
    return T.let(found, lambda w: F.concat(w, F.when(F.size(w) >= 2, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), pair)).otherwise(F.array().cast("array<string>"))))


def tfidf_pair(a: Column | str, b: Column | str, stopwords: Iterable[str] = SHORT_STOPWORDS, digits: int = 4) -> Column:
    """Cosine of the TF-IDF vectors fitted on just the two texts (SC50), in closed form.

    A term of both texts weighs 1, a term of one 1 + ln 1.5; so only the counts of terms matter. Null where either text is
    empty or no term is left in both.
    """
    single = 1 + F.log(F.lit(1.5))
    zero = F.lit(0.0)

    def closed(acc):
        """The sums with the term that ends here."""
        weight = F.when((acc["x"] > 0) & (acc["y"] > 0), F.lit(1.0)).otherwise(single)
        square = lambda n: n * n * weight * weight
        return acc["dot"] + acc["x"] * acc["y"], acc["xx"] + square(acc["x"]), acc["yy"] + square(acc["y"])

    def state(term, x, y, dot, xx, yy):
        return F.struct(term.alias("term"), x.alias("x"), y.alias("y"), dot.alias("dot"), xx.alias("xx"), yy.alias("yy"))

    def step(acc, item):
        x, y = item["side"], 1 - item["side"]
        more = state(acc["term"], acc["x"] + x, acc["y"] + y, acc["dot"], acc["xx"], acc["yy"])
        return F.when(item["term"] == acc["term"], more).otherwise(state(item["term"], x, y, *closed(acc)))

    def done(acc):
        return T.let(F.struct(*[c.alias(k) for k, c in zip(("dot", "xx", "yy"), closed(acc), strict=True)]), lambda s: T.let(F.sqrt(s["xx"]) * F.sqrt(s["yy"]), lambda n: F.when(n == 0, zero).otherwise(F.round(s["dot"] / n, digits))))

    # the terms of both texts in one sorted list: equal ones are neighbours, and one pass counts them
    tagged = lambda c, side: F.transform(tfidf_terms(c, stopwords), lambda t: F.struct(t.alias("term"), F.lit(side).alias("side")))
    of = lambda terms: F.when(F.size(terms) > 0, F.aggregate(terms, state(F.lit(""), zero, zero, zero, zero, zero), step, done))
    return F.when((T.safe(a) != "") & (T.safe(b) != ""), T.let(F.array_sort(F.concat(tagged(a, 1.0), tagged(b, 0.0))), of))
