"""Scores of rows, phrases and examples as sums of weighted conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L
from . import text as T
from .rules import score, steps


def last_token(tokens: Column) -> Column:
    return F.try_element_at(tokens, F.lit(-1))


def has_cue(tokens: Column, cues=L.CUES) -> Column:
    return F.exists(tokens, lambda t: t.isin(*cues))


def strong_pattern(idiom: Column, patterns=L.STRONG_PATTERNS) -> Column:
    """A phrasal pattern of two words in order (SC34)."""
    return T.any_match(idiom, patterns)


def confidence_score(c="idiom_confidence") -> Column:
    """(SC22)"""
    return T.lookup(T.lower_norm(c), L.CONFIDENCE, 0)


def source_priority(c="source", ranks=L.PRIORITY_STAGE_2) -> Column:
    """(SC22)"""
    return T.lookup(T.lower_norm(c), ranks, 0)


def phrase_pos(c="pos") -> Column:
    return T.lower_norm(c).isin(*L.PHRASE_POS)


def clean_score(hint="idiom_hint", pos="pos", tags="tags", example="example") -> Column:
    """Evidence for an idiom among dictionary rows."""
    return score((T.col(hint) == 1, 3), (F.lower(T.safe(pos)).isin(*L.PHRASE_POS), 3), (T.any_in(F.lower(T.safe(tags)), L.CLEAN_SCORE_TAGS), 2), (T.safe(example) != "", 1))


def precision_score(hint="idiom_hint", pos="pos", tags="tags", meaning="meaning", example="example") -> Column:
    return score((T.any_in(F.lower(T.safe(tags)), L.PRECISE_TAGS), 3), (F.lower(T.safe(pos)).isin(*L.PHRASE_POS), 3), (T.any_in(F.lower(T.safe(meaning)), L.PRECISE_TAGS), 2), (T.col(hint) == 1, 2), (T.safe(example) != "", 1))


def global_score(source="source", tags="tags", pos="pos", example="example") -> Column:
    s = T.safe(source)
    return score((s.isin(*L.CURATED_SOURCES), 4), (s == "kaikki_wiktionary", 3), (s == "wordnet", 1), (T.any_in(F.lower(T.safe(tags)), L.STRONG_TAGS), 3), (F.lower(T.safe(pos)).isin(*L.PHRASE_POS), 2), (T.safe(example) != "", 1))


def _phrase_length(n: Column) -> Column:
    return steps((n.between(2, 5), 2), (n.between(6, 8), 1))


def crowd_score(idiom="idiom", meaning="meaning_en", example="example", tags="tags") -> Column:
    """(SC23)"""
    i, e = T.idiom_key(idiom), T.norm(example)
    shown = (i != "") & (e != "") & F.contains(F.lower(e), i)
    return _phrase_length(T.token_count(idiom)) + score((T.norm(meaning) != "", 3), (T.token_count(example) >= 3, 2), (T.any_in(T.lower_norm(tags), L.CROWD_TAGS), 2), (shown, 1), (i.isin(*L.CROWD_WEAK), -3), (T.token_count(meaning) < 4, -1))


def slang_score(idiom="idiom", meaning="meaning_en", example="example", tags="tags", pos="pos") -> Column:
    """(SC24)"""
    t = T.lower_norm(tags)
    return score((phrase_pos(pos), 3), (T.any_in(t, ("slang", "informal", "colloquial", "internet")), 3), (T.any_in(t, L.STRONG_TAGS), 2), (T.any_in(T.lower_norm(meaning), L.FIGURATIVE_MEANINGS), 2), (T.norm(example) != "", 1), (T.token_count(idiom).between(2, 5), 1))


def slang_clean_score(idiom="idiom", meaning="meaning_en", example="example", tags="tags", pos="pos") -> Column:
    """(SC25)"""
    t, p = T.lower_norm(tags), T.lower_norm(pos)
    return _phrase_length(T.token_count(idiom)) + steps((p.isin(*L.PHRASE_POS), 3), (p.isin("verb", "adjective", "adverb", "noun", "interjection"), 1)) + score(
        (T.norm(meaning) != "", 3), (T.token_count(example) >= 3, 2), (T.any_in(t, ("slang", "informal", "colloquial", "internet")), 3), (T.any_in(t, ("idiomatic", "figurative", "idiom", "sarcastic", "humorous", "meme")), 2),
        (T.any_in(T.lower_norm(meaning), L.FIGURATIVE_MEANINGS), 2), (~T.any_prefix(T.idiom_key(idiom), L.PRONOUN_STARTS), 1))


def merge_score_1(source="source", confidence="idiom_confidence", pos="pos", tags="tags", example="example") -> Column:
    """(SC26)"""
    return confidence_score(confidence) * 3 + source_priority(source, L.PRIORITY_STAGE_1) * 2 + score((T.norm(example) != "", 4), (phrase_pos(pos), 2), (T.any_in(T.lower_norm(tags), L.MERGE_TAGS), 1))


def _shape(n: Column, tokens: Column) -> Column:
    return steps((n.isin(3, 4), 2), (n == 5, 1)) + score((last_token(tokens).isin(*L.PARTICLES), 2), (has_cue(tokens), 2))


def merge_score_2(idiom="idiom", meaning="meaning_en", source="source", confidence="idiom_confidence", pos="pos", tags="tags", example="example") -> Column:
    """(SC27)"""
    tokens = T.words(idiom)
    return _shape(F.size(tokens), tokens) + confidence_score(confidence) * 3 + source_priority(source) * 3 + steps((T.norm(meaning) != "", 5), otherwise=1) + score((T.norm(example) != "", 4), (phrase_pos(pos), 2), (T.any_in(T.lower_norm(tags), L.MERGE_TAGS), 2))


def shape_score(idiom: Column | str) -> Column:
    """(SC28)"""
    i = T.idiom_key(idiom)
    tokens = T.tokens(i)
    content = F.size(F.array_distinct(T.without(tokens, L.STOPWORDS)))
    return _shape(F.size(tokens), tokens) + score((content >= 3, 1), (strong_pattern(i, L.MODERN_STRONG_PATTERNS), 3))


def example_score(example: Column | str, idiom: Column, ideal: tuple[int, int] = (5, 18), fair: tuple[int, int] = (4, 24)) -> Column:
    """(SC29) Mining takes ideal (5, 16) and fair (4, 20)."""
    e = T.norm(example)
    n = F.regexp_count(T.idiom_key(example), F.lit(T.WORD))
    return steps((n.between(*ideal), 3), (n.between(*fair), 2), otherwise=1) + score((e != "", 2), ((idiom != "") & F.contains(F.lower(e), idiom), 2), (T.is_upper(e), -2)) - F.regexp_count(e, F.lit(T.BAD_CHARS))


def lexical_score(tokens: Column) -> Column:
    """(SC30)"""
    content = T.without(tokens, L.STOPWORDS)
    return F.size(F.array_distinct(content)) + score((has_cue(tokens, L.MINING_CUES), 2), (last_token(tokens).isin(*L.PARTICLES), 2), (F.size(content) >= 3, 1))


def candidate_score(idiom="idiom", example="example", tags="tags") -> Column:
    """(SC31)"""
    i = T.idiom_key(idiom)
    tokens = T.tokens(i)
    content = F.size(F.array_distinct(T.without(tokens, L.STOPWORDS)))
    n = F.size(tokens)
    return example_score(example, i) + steps((content >= 3, 2), (content == 2, 1)) + steps((n.isin(3, 4), 2), (n == 5, 1)) + score((strong_pattern(i), 5), (has_cue(tokens), 3), (last_token(tokens).isin(*L.PARTICLES), 2), (F.contains(T.lower_norm(tags), F.lit("repeated_ngram")), 1))


def best_row_score(idiom="idiom", meaning="meaning_en", example="example", source="source", tags="tags", pos="pos", confidence="idiom_confidence") -> Column:
    """(SC32)"""
    i = T.idiom_key(idiom)
    return source_priority(source) * 3 + confidence_score(confidence) * 2 + shape_score(i) + example_score(example, i) + score((T.norm(meaning) != "", 5), (T.norm(example) != "", 4), (T.any_in(T.lower_norm(tags), L.MODERN_TAGS), 2), (phrase_pos(pos), 2), (strong_pattern(i, L.MODERN_STRONG_PATTERNS), 3))


def before_enrichment_score(meaning="idiom_canonical_meaning", example="example", source="source", confidence="idiom_confidence", tags="tags", pos="pos") -> Column:
    """(SC33)"""
    s = T.lower_norm(source)
    trust = steps((F.contains(s, F.lit("wiktionary")), 4), (F.contains(s, F.lit("urban")), 3), (F.contains(s, F.lit("opensubtitles")), 1))
    return trust * 3 + confidence_score(confidence) * 2 + score((T.norm(meaning) != "", 5), (T.norm(example) != "", 1), (T.any_in(T.lower_norm(tags), ("idiomatic", "figurative", "slang", "colloquial")), 2), (phrase_pos(pos), 1))


def tier(similarity="similarity", high: float = 0.35, medium: float = 0.18) -> Column:
    """Quality tier of a similarity (SC52-SC54): (0.35, 0.15), (0.40, 0.20) and (0.35, 0.18) are in use; null stays null."""
    s = T.col(similarity)
    return F.when(s >= high, "high").when(s >= medium, "medium").when(s.isNotNull(), "low")
