"""Row filters as boolean Columns. The columns they look at are parameters; the defaults are the common schema's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L
from . import text as T
from .scores import example_score, has_cue, last_token, shape_score, strong_pattern


def english_phrase(word="word", least: int = 2, most: int = 8) -> Column:
    """No meta prefix, a blank or hyphen, 2-8 tokens, a Latin letter (FLT1)."""
    w = T.norm(word)
    n = T.token_count(word)
    return ~w.isin(*L.EMPTY_TERMS) & ~T.any_prefix(w, L.META_PREFIXES) & F.rlike(w, F.lit("[ -]")) & n.between(least, most) & T.has_letters(w)


def useful_sense(meaning="meaning") -> Column:
    """A meaning that isn't that of an inflection or variant (FLT2)."""
    m = T.lower_norm(meaning)
    return (m != "") & ~T.any_in(m, L.VARIANT_MEANINGS)


def language_is(language="lang", name: str = "English") -> Column:
    """(FLT3)"""
    return T.col(language) == name


def strict_phrase(idiom="idiom") -> Column:
    """A blank, 2-7 tokens, not all capitals, no symbols (FLT4)."""
    i = T.safe(idiom)
    return F.contains(i, F.lit(" ")) & T.token_count(idiom).between(2, 7) & ~T.is_upper(i) & ~F.rlike(i, F.lit(T.BAD_SYMBOLS_NO_BAR))


def pos_allowed(pos="pos") -> Column:
    """(FLT5)"""
    return ~F.lower(T.safe(pos)).isin(*L.STRICT_BAD_POS)


def meaning_allowed(patterns, meaning="meaning", empty: bool = True) -> Column:
    """No pattern matches; ``empty`` says whether an empty meaning is allowed (FLT6 and its kin)."""
    m = T.idiom_key(meaning)
    return F.when(m == "", F.lit(empty)).otherwise(~T.any_match(m, patterns))


def idiom_signal(pos="pos", hint="idiom_hint", tags="tags", meaning="meaning") -> Column:
    """(FLT7)"""
    return F.lower(T.safe(pos)).isin(*L.PHRASE_POS) | (F.coalesce(T.col(hint), F.lit(0)) == 1) | T.any_in(F.lower(T.safe(tags)), L.STRICT_TAGS) | T.any_in(F.lower(T.safe(meaning)), L.PRECISE_TAGS)


def odd_characters(c="idiom") -> Column:
    """Characters other than letters, digits, white space, apostrophe, hyphen and dollar."""
    return F.length(F.regexp_replace(T.safe(c), r"(?U)[\p{L}\p{N}\s'$-]", ""))


def clean_row(idiom="idiom", meaning="meaning", tags="tags") -> Column:
    """(FLT8)"""
    i = T.safe(idiom)
    shape = T.token_count(idiom).between(2, 7) & ~F.rlike(i, F.lit(T.BAD_SYMBOLS_NO_BAR)) & T.has_letters(i)
    return shape & meaning_allowed(L.CLEAN_BAD_MEANINGS, meaning) & ~T.any_in(F.lower(T.safe(tags)), L.CLEAN_BAD_TAGS) & (odd_characters(idiom) <= 2)


def high_precision(pos="pos", hint="idiom_hint", tags="tags", meaning="meaning") -> Column:
    """Any of four strong signals (FLT9)."""
    return T.any_in(F.lower(T.safe(tags)), L.PRECISE_TAGS) | F.lower(T.safe(pos)).isin(*L.PHRASE_POS) | T.any_in(F.lower(T.safe(meaning)), L.PRECISE_TAGS) | (F.coalesce(T.col(hint), F.lit(0)) == 1)


def global_basics(idiom="idiom", meaning="meaning_en") -> Column:
    """(FLT10)"""
    i = T.safe(idiom)
    return T.token_count(idiom).between(2, 7) & T.has_letters(i) & ~F.rlike(i, F.lit(T.BAD_SYMBOLS_NO_BAR)) & meaning_allowed(L.GLOBAL_BAD_MEANINGS, meaning)


def strong_signal(source="source", tags="tags", pos="pos", meaning="meaning_en", confidence="idiom_confidence") -> Column:
    """(FLT11)"""
    s = F.lower(T.safe(source))
    return s.isin(*L.CURATED_SOURCES) | T.any_in(F.lower(T.safe(tags)), L.STRONG_TAGS) | F.lower(T.safe(pos)).isin(*L.PHRASE_POS) | T.any_in(F.lower(T.safe(meaning)), L.STRONG_TAGS) | ((F.lower(T.safe(confidence)) == "high") & (s == "kaikki_wiktionary"))


def broad_signal(idiom="idiom", source="source", tags="tags", pos="pos", meaning="meaning_en", confidence="idiom_confidence") -> Column:
    """(FLT12)"""
    lexical = (F.lower(T.safe(source)) == "wordnet") & (T.any_in(F.lower(T.safe(idiom)), L.PREPOSITIONS) | T.any_in(F.lower(T.safe(meaning)), L.FIGURATIVE_MEANINGS))
    return strong_signal(source, tags, pos, meaning, confidence) | lexical | T.any_in(F.lower(T.safe(tags)), L.GLOBAL_TAGS)


def explicit(*columns, word_boundary: bool = False, terms: tuple[str, ...] = L.EXPLICIT) -> Column:
    """A term of the explicit list as a substring (or, if asked, as a word) of any column (FLT13)."""
    test = T.any_word_in if word_boundary else T.any_in
    found = F.lit(False)
    for c in columns:
        found = found | test(T.lower_norm(c), terms)
    return found


def good_phrase(idiom="idiom", least: int = 2, most: int = 8) -> Column:
    i = T.idiom_key(idiom)
    return (i != "") & T.has_letters(i) & ~F.rlike(i, F.lit(T.BAD_SYMBOLS)) & T.token_count(idiom).between(least, most)


def crowd_row(idiom="idiom", meaning="meaning_en", example="example") -> Column:
    """(FLT14)"""
    return good_phrase(idiom) & meaning_allowed(L.CROWD_BAD_MEANINGS, meaning, empty=False) & ~explicit(idiom, meaning, example)


def slang_signal(tags: Column, topics: Column, meaning: Column, raw_glosses: Column, pos: Column) -> Column:
    """A slang or figurative hint in the bag of an entry's texts; tags, topics and glosses are arrays (FLT15)."""
    low = lambda a: F.transform(F.coalesce(a, F.array().cast("array<string>")), T.lower_norm)
    bag = F.concat_ws(" ", low(tags), low(topics), T.lower_norm(meaning), F.array_join(low(raw_glosses), " "), F.lower(pos))
    return T.any_in(bag, (*L.SLANG_TAGS, *L.ENTRY_HINTS))


def slang_entry(word: Column, pos: Column, tags: Column, meaning: Column) -> Column:
    """Shape, part of speech, exact bad tags and meaning of a dictionary slang sense (FLT15)."""
    w = T.norm(word)
    bad = T.literals(L.CLEAN_BAD_TAGS)
    clean = F.transform(F.coalesce(tags, F.array().cast("array<string>")), T.lower_norm)
    p = F.lower(F.coalesce(pos, F.lit("")))
    return good_phrase(word) & ~w.isin(*L.EMPTY_TERMS) & ~T.any_prefix(w, L.META_PREFIXES) & ((p == "") | p.isin(*L.GOOD_POS)) & ~F.arrays_overlap(clean, bad) & meaning_allowed(L.SLANG_BAD_MEANINGS, meaning, empty=False)


def weak_generic(idiom="idiom", meaning="meaning_en", tags="tags") -> Column:
    """A weak phrase without both a strong tag and a figurative meaning (FLT16)."""
    strong = F.arrays_overlap(T.tag_list(tags), T.literals(L.SLANG_STRONG_TAGS))
    return T.idiom_key(idiom).isin(*L.SLANG_WEAK) & ~(strong & T.any_in(T.idiom_key(meaning), L.FIGURATIVE_MEANINGS))


def too_literal(idiom="idiom", meaning="meaning_en", tags="tags", pos="pos") -> Column:
    """(FLT17)"""
    m = T.idiom_key(meaning)
    strong = F.arrays_overlap(T.tag_list(tags), T.literals(L.SLANG_STRONG_TAGS)) | T.any_in(m, (*L.FIGURATIVE_MEANINGS, "sarcastic", "humorous")) | T.lower_norm(pos).isin(*L.PHRASE_POS)
    n, i = T.token_count(meaning), T.token_count(idiom)
    return ~strong & (T.any_in(m, L.GENERIC_WORDS) | (n <= 3) | ((i <= 3) & (n <= 6)))


def raw_dialogue_line(line="text", least: int = 8, clean: bool = False) -> Column:
    """(FLT18) ``clean``: the line is normalised already, so that its blanks tell the tokens."""
    own = T.col(line)
    tokens = F.length(own) - F.length(F.replace(own, F.lit(" "), F.lit(""))) + 1 if clean else T.token_count(line)
    return F.length(own if clean else T.norm(line)).between(least, 250) & T.has_letters(own) & tokens.between(3, 40)


def bad_characters(c: Column) -> Column:
    return F.regexp_count(c, F.lit(T.BAD_CHARS))


def mining_line(line="text", clean: bool = False) -> Column:
    """(FLT19) ``clean``: the line is normalised already."""
    own = T.col(line) if clean else T.norm(line)
    words = F.regexp_count(F.translate(F.lower(own), "’", "'"), F.lit(T.WORD))
    return F.length(own).between(8, 180) & T.has_letters(T.col(line)) & (bad_characters(T.col(line)) <= 2) & words.between(3, 25)


def _dialogue_phrase(phrase: Column, tokens: Column, blocked, starts, weak_words, scaffold: str | None) -> Column:
    # cheap tests of the ends first; the word lists are looked up for what is left
    ends = tuple(w for w in L.STOPWORDS if w not in L.PARTICLES)
    ok = F.size(tokens).between(3, 5) & ~F.get(tokens, F.lit(0)).isin(*L.PRONOUNS) & ~last_token(tokens).isin(*ends) & ~phrase.isin(*blocked)
    ok = ok & ~T.any_prefix(phrase, (*L.BLOCKED_STARTS, *starts)) & ~F.rlike(phrase, F.lit(T.BAD_SYMBOLS)) & T.has_letters(phrase)
    few_weak = lambda c: (F.size(c) >= 2) & (F.size(F.filter(c, lambda t: t.isin(*weak_words))) < 2)
    ok = ok & T.let(T.without(tokens, L.STOPWORDS), few_weak)
    return ok if scaffold is None else ok & ~F.rlike(phrase, F.lit(f"(?iU){scaffold}"))


def mining_phrase(phrase: Column, tokens: Column) -> Column:
    """Structure of a candidate n-gram (FLT20; FLT21 is implied)."""
    return _dialogue_phrase(phrase, tokens, L.MINING_BLOCKED, L.MINING_LITERAL_STARTS, L.MINING_WEAK_WORDS, L.MINING_SCAFFOLDS)


def spoken_signal(tokens: Column) -> Column:
    """A cue word or a closing particle (FLT22)."""
    return has_cue(tokens, L.MINING_CUES) | ((F.size(tokens) >= 2) & last_token(tokens).isin(*L.PARTICLES))


def candidate_phrase(idiom="idiom") -> Column:
    """(FLT23)"""
    i = T.idiom_key(idiom)
    n = F.regexp_count(i, F.lit(T.WORD))
    return _dialogue_phrase(i, T.tokens(i), L.WEAK_PHRASES, L.LITERAL_STARTS, L.WEAK_WORDS, L.SCAFFOLDS) & n.between(3, 5)


def candidate_too_literal(idiom="idiom", example="example") -> Column:
    """(FLT23) A strong phrasal pattern overrides everything else."""
    i = T.idiom_key(idiom)
    tokens = T.tokens(i)
    content = F.size(T.without(tokens, L.STOPWORDS))
    plain = ~has_cue(tokens) & ~last_token(tokens).isin(*L.PARTICLES) & (content <= 2)
    literal = i.isin(*L.WEAK_PHRASES) | T.any_prefix(i, L.BLOCKED_STARTS) | T.any_prefix(i, L.LITERAL_STARTS) | F.rlike(i, F.lit(f"(?iU){L.SCAFFOLDS}")) | (content < 2) | plain | (example_score(T.idiom_key(example), i) <= 1)
    return ~strong_pattern(i) & literal


def modern_phrase(idiom="idiom") -> Column:
    i = T.idiom_key(idiom)
    return _dialogue_phrase(i, T.tokens(i), L.MODERN_WEAK_PHRASES, L.LITERAL_STARTS, L.WEAK_WORDS, None)


def broad_keep(idiom="idiom", meaning="meaning_en", example="example", tags="tags", pos="pos", source="source") -> Column:
    """Source-dependent decision (FLT24)."""
    i, m, e, s = T.idiom_key(idiom), T.norm(meaning), T.norm(example), T.lower_norm(source)
    shape = shape_score(i)
    by_source = F.when(s.isin(*L.DICTIONARY_SOURCES), True).when(s == L.DIALOGUE_SOURCE, strong_pattern(i, L.MODERN_STRONG_PATTERNS) | ((shape >= 4) & (example_score(example, i) >= 4)))
    by_source = by_source.otherwise((shape >= 3) | T.any_in(T.lower_norm(tags), L.MODERN_TAGS) | T.lower_norm(pos).isin(*L.PHRASE_POS))
    return modern_phrase(idiom) & meaning_allowed(L.MODERN_BAD_MEANINGS, meaning) & ((m != "") | (e != "")) & by_source


def high_quality_keep(idiom="idiom", meaning="meaning_en", example="example", tags="tags", pos="pos", source="source", confidence="idiom_confidence") -> Column:
    """(FLT25) To be applied to the broad set after its selection of best rows."""
    i, m, s = T.idiom_key(idiom), T.norm(meaning), T.lower_norm(source)
    shape, ex = shape_score(i), example_score(example, i)
    tag = T.any_in(T.lower_norm(tags), L.MODERN_TAGS)
    lexical = (s.isin(*L.DICTIONARY_SOURCES) & ((shape >= 3) | tag | T.lower_norm(pos).isin(*L.PHRASE_POS))) | (T.lower_norm(confidence).isin("high", "medium") & ((shape >= 4) | tag))
    spoken = (s == L.DIALOGUE_SOURCE) & ((strong_pattern(i, L.MODERN_STRONG_PATTERNS) & (ex >= 4)) | ((shape >= 6) & (ex >= 5)))
    return F.when((m != "") & ~meaning_allowed(L.MODERN_BAD_MEANINGS, meaning), False).otherwise(((m != "") & lexical) | spoken)


def generated_candidate(idiom="idiom_candidate") -> Column:
    """2-6 tokens and no literal start (FLT26); null never is."""
    i = F.lower(T.safe(idiom))
    starts = ("go to", "make a", "have a", "do a", "get a", "take a", "go for", "come to")
    return T.col(idiom).isNotNull() & T.token_count(idiom).between(2, 6) & ~T.any_prefix(i, starts)


def valid_idiom(flag="is_idiom", validity="idiom_validity_label") -> Column:
    """(FLT28)"""
    return F.coalesce(T.col(flag), F.lit(False)) & (F.coalesce(T.col(validity), F.lit("")) == "valid_idiom")


def has_canonical(idiom="idiom_canonical") -> Column:
    """(FLT38)"""
    return T.safe(idiom) != ""


def corrupted_example(example="example") -> Column:
    """Metadata fragments, or two colons in over 300 characters (FLT29)."""
    e = F.coalesce(T.col(example), F.lit(""))
    return F.rlike(e, F.lit(r"idiom_in_example_|(?:meaning[_\s]?.*?:)|(?:en\s*:)")) | ((F.regexp_count(e, F.lit(":")) >= 2) & (F.length(e) > 300))


def trivial_example(example="example", idiom="idiom_canonical") -> Column:
    """The example is the idiom (FLT31, FLT33)."""
    return T.equality_normalized(example) == T.equality_normalized(idiom)


def task_row(quality="semantic_quality", status="validation_status", label="example_usage_label") -> Column:
    """Strong or validated, and not borderline; a null label passes (FLT35)."""
    return ((F.coalesce(T.col(quality), F.lit("")) == "high") | F.coalesce(T.col(status), F.lit("")).isin("verified", "corrected")) & ~T.col(label).eqNullSafe("borderline")
