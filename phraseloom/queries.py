"""Registered queries of the engine's own operators, each with the SQL that an independent engine answers it with.

Idiom, enrichment and metadata rows are projected from the driver's tables by expressions that both engines read alike
(IDIOMS, ENRICHED, METADATA); every row of a table takes part.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import predicates as P
from phraseloom.functions import scores as S
from phraseloom.functions import similarity as Sim
from phraseloom.functions import text as T
from phraseloom.functions.rules import cascade
from phraseloom.operators import dedup as D
from phraseloom.operators import enrich as E
from phraseloom.operators import joins as J
from phraseloom.operators import mining as M
from phraseloom.operators import publish as Pub
from phraseloom.operators import schema as Sch
from phraseloom.operators import stats as St
from phraseloom.operators import validate as V
from phraseloom.operators import windows as W
from phraseloom.plans import pipelines as Plan
from phraseloom.sources import pages as Pages
from phraseloom.sources import readers as R

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

IDIOMS = {
    "_pos": "p_partkey",
    "idiom": "case p_partkey % 9 when 0 then concat('Blow ', p_name, ' off') when 1 then concat('cut some ', p_name) when 2 then upper(p_name) when 3 then 'i want it now' when 4 then concat(p_name, ' <b>') when 5 then concat('get ', p_name, ' over') when 6 then 'for real' when 7 then concat('the thing of ', p_name) else p_name end",
    "meaning": "case p_partkey % 7 when 0 then concat('a kind of ', p_type) when 1 then '' when 2 then concat('to act in a figurative way with ', p_brand) when 3 then concat('plural of ', p_name) when 4 then concat('something odd, informal: ', lower(p_type)) when 5 then concat('when method ', p_type) else concat(p_type, ' ', p_brand) end",
    "example": "case p_partkey % 4 when 0 then null when 1 then concat('They ', p_name, ' all day and blow it off again.') when 2 then concat('LOOK AT ', upper(p_name), ' {NOW}') else concat('Just ', p_name) end",
    "tags": "case p_partkey % 5 when 0 then 'idiomatic, informal' when 1 then 'alt-of' when 2 then 'slang,figurative' when 3 then null else '' end",
    "pos": "case p_partkey % 4 when 0 then 'phrase' when 1 then 'name' when 2 then 'Verb' else null end",
    "source": "case p_partkey % 6 when 0 then 'kaikki_wiktionary' when 1 then 'wordnet' when 2 then 'phrasefinder' when 3 then 'urban_dictionary' when 4 then 'opensubtitles_dialogue' else 'wiktionary_slang_kaikki' end",
    "idiom_confidence": "case p_partkey % 3 when 0 then 'high' when 1 then 'Medium' else 'low' end",
    "idiom_hint": "cast(p_partkey % 2 as int)",
    "brand": "p_brand",
    "size": "p_size",
}
ENRICHED = {
    "_pos": "doc_id",
    "idiom_id": "case when doc_id % 41 = 0 then '' else concat('i', cast(floor(doc_id / 14) as bigint)) end",
    "idiom_canonical": "concat('idiom ', cast(floor(doc_id / 14) as bigint))",
    "row_type": "case when doc_id % 43 = 0 then 'other' when doc_id % 14 < 12 then 'main_example' else concat('adversarial_example_', cast(doc_id % 14 - 11 as bigint)) end",
    "context_type": "case when doc_id % 14 >= 12 then 'adversarial' when doc_id % 12 < 2 then 'dialogue' when doc_id % 12 < 4 then 'narrative' when doc_id % 12 < 6 then 'formal' when doc_id % 12 < 8 then 'social_media' when doc_id % 12 < 10 then 'question' else 'sarcastic' end",
    "source_style": "case when doc_id % 14 >= 12 then 'synthetic_adversarial' when doc_id % 37 = 0 then 'odd' else 'synthetic_formal' end",
    "idiom_surface": "case when doc_id % 14 >= 12 then null when doc_id % 5 = 0 then 'zzz qqq the' else 'the' end",
    "idiom_in_example": "case when doc_id % 31 = 0 then ' ' when doc_id % 29 = 0 then 'word' else concat('the ', text) end",
    "idiom_in_example_arabic": "case when doc_id % 23 = 0 then null else 'ar' end",
    "idiom_in_example_meaning_en": "'m'", "idiom_in_example_meaning_arabic": "'m'", "explanation_en": "'e'", "explanation_ar": "'e'",
    "idiom_level_explanation_en": "case when doc_id % 19 = 0 then '' else 'e' end", "idiom_level_explanation_ar": "'e'",
    "hard_negative_idioms": "case when doc_id % 17 = 0 then '[\"a\",\"b\"]' else '[\"a\",\"b\",\"c\"]' end",
    "meaning_paraphrases_en": "'[\"a\",\"b\",\"c\"]'", "meaning_paraphrases_ar": "'[\"a\",\"b\",\"c\"]'",
    "example_usage_label": "case when doc_id % 13 = 0 then 'borderline' when doc_id % 2 = 0 then 'idiomatic' else 'literal' end",
    "expected_label": "case when doc_id % 47 = 0 then 'odd' else 'literal' end",
    "is_example_idiom": "case when doc_id % 53 = 0 then null when doc_id % 11 = 0 then 'False' when doc_id % 2 = 0 then 'True' else '0' end",
    "is_adversarial_example": "case when doc_id % 14 >= 12 then '1' else 'false' end",
    "minimal_pair_id": "case when doc_id % 7 = 6 then null else 'p' end",
    "adversarial_type": "case when doc_id % 14 < 12 then '' when doc_id % 3 = 0 then 'odd' else 'negation' end",
}
METADATA = {
    "_pos": "d.doc_id", "idiom_canonical": "d.lang", "example": "d.source", "label": "case l.quality when 1 then 'idiomatic' when 0 then 'literal' end",
    "flag": "case when l.toxic is null then null else l.toxic = 1 end", "meaning": "case when l.quality is null then null else concat('m', cast(d.doc_id as varchar(20))) end", "src": "d.source",
}


def _view(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}"


IDIOMS_SQL = _view(IDIOMS, "part")
ENRICHED_SQL = _view(ENRICHED, "documents")
META_SQL = _view(METADATA, "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
LINES_SQL = "SELECT doc_id, i AS line_no, parts[i + 1] AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents), LATERAL (SELECT unnest(range(len(parts))) AS i)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def idioms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "part"), IDIOMS)


def sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idioms(spark, sf_dir).withColumnRenamed("meaning", "meaning_en")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "documents"), ENRICHED)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = table(spark, sf_dir, "documents").alias("d"), table(spark, sf_dir, "labels").alias("l")
    return _project(d.join(l, F.col("d.doc_id") == F.col("l.doc_id"), "left"), METADATA)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.split_lines(R.spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def query(name: str, sql: str | None = None, **views: str):
    """Register a query; ``views`` become CTEs of its SQL."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ctes = ", ".join(f"{k} AS ({v})" for k, v in views.items())
            ORACLES[name] = f"WITH {ctes} {sql}" if ctes else sql
        return f

    return add


# SQL spellings of the text functions; the tables' white space is ASCII.
def s_norm(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


def s_safe(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^\\s+|\\s+$', '', 'g')"


def s_key(c: str) -> str:
    return f"replace(lower({s_norm(c)}), '’', '''')"


def s_count(c: str) -> str:
    return f"(CASE WHEN {s_norm(c)} = '' THEN 0 ELSE len(string_split({s_norm(c)}, ' ')) END)"


def s_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def s_any(c: str, values) -> str:
    return "(" + " OR ".join(f"contains({c}, '" + v.replace("'", "''") + "')" for v in values) + ")"


def s_prefix(c: str, values) -> str:
    return "(" + " OR ".join(f"starts_with({c}, '" + v.replace("'", "''") + "')" for v in values) + ")"


def s_match(c: str, patterns) -> str:
    return f"regexp_matches({c}, '" + "|".join(f"(?:{p})" for p in patterns).replace("'", "''") + "')"


def s_case(c: str, mapping: dict, default="NULL") -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v if isinstance(v, int) else repr(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


def s_arr(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


NOBAR = r"[<>\[\]{}_=+*/\\]"
BAR = r"[<>\[\]{}_=+*/\\|]"
CONTENT = f"list_filter(toks, lambda t: NOT list_contains({s_arr(L.STOPWORDS)}, t))"
LAST = "toks[len(toks)]"


def s_has(values, toks: str = "toks") -> str:
    return f"list_has_any({toks}, {s_arr(values)})"


# --- text functions -------------------------------------------------------------------------------------------------------------
@query("q_line_normalize", "SELECT doc_id, line_no, text FROM (SELECT doc_id, line_no, " + "CASE WHEN regexp_matches(t, '^\\d+$') OR regexp_matches(t, '^\\d{1,2}:\\d{2}(?::\\d{2})?(?:,\\d{1,3})?$') THEN '' ELSE t END AS text FROM (SELECT doc_id, line_no, " + s_norm("translate(regexp_replace(regexp_replace(regexp_replace(" + s_norm("text") + ", '\\[(.*?)\\]|\\((.*?)\\)|\\{(.*?)\\}', ' ', 'g'), '^\\s*[A-Z][A-Z0-9 _-]{1,25}:\\s+', ''), '^\\s*[-–—]+\\s*', ''), '“”’‘', '\"\"''''')") + " AS t FROM lines)) WHERE length(text) BETWEEN 8 AND 250 AND regexp_matches(text, '[A-Za-z]') AND " + s_count("text") + " BETWEEN 3 AND 40", lines=LINES_SQL)
def _line_normalize(spark, d):
    rows = T.once(lines(spark, d), text=T.dialogue_line("text"))
    return rows.where(P.raw_dialogue_line("text", clean=True)).select("doc_id", "line_no", "text")


@query("q_example_normalized", f"SELECT doc_id, md5({s_norm(chr(114) + 'egexp_replace(lower(text), ' + chr(39) + '[^\\p{L}\\p{N}_\\s]' + chr(39) + ', ' + chr(39) + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}) AS deleted, md5({s_norm(chr(114) + 'egexp_replace(lower(text), ' + chr(39) + '[^\\p{L}\\p{N}_\\s]' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}) AS spaced, length(text) AS chars, {s_count('text')} AS words FROM documents")
def _example_normalized(spark, d):
    md5 = lambda c: F.md5(c.cast("binary"))
    return table(spark, d, "documents").select("doc_id", md5(T.example_normalized("text")).alias("deleted"), md5(T.equality_normalized("text")).alias("spaced"), F.length("text").alias("chars"), T.token_count("text").alias("words"))


@query("q_tidy_example", f"SELECT doc_id, md5({s_norm(chr(39).join(['regexp_replace(regexp_replace(text, ', chr(92) + 's+', ', ', ' ', ', ', 'g', '), ', chr(92) + 's+([,.!?;:])', ', ', chr(92) + '1', ', ', 'g', ')']))}) AS tidy FROM documents")
def _tidy_example(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.tidy_example("text").cast("binary")).alias("tidy"))


@query("q_token_stats", "SELECT count(*) AS count, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std, round(min(n), 4) AS min, round(quantile_cont(n, 0.25), 4) AS p25, round(quantile_cont(n, 0.5), 4) AS median, round(quantile_cont(n, 0.75), 4) AS p75, round(max(n), 4) AS max FROM (SELECT len(regexp_extract_all(text, '\\S+'))::DOUBLE AS n FROM documents)")
def _token_stats(spark, d):
    return St.numeric_summary(table(spark, d, "documents"), T.word_count("text"))


@query("q_keys", f"SELECT _pos, {s_key('idiom')} AS key, concat({s_key('idiom')}, ' || ', {s_key('meaning')}) AS pair, concat('idiom_', substr(md5(concat(lower({s_norm('idiom')}), ' || ', lower({s_norm('meaning')}))), 1, 12)) AS id, regexp_replace({s_safe('idiom')}, '\\s+', '_', 'g') AS slug, CASE WHEN {s_norm('idiom')} = '' THEN '' ELSE concat('https://x/', replace(url_encode({s_norm('idiom')}), '+', '%20')) END AS url FROM idioms", idioms=IDIOMS_SQL)
def _keys(spark, d):
    return idioms(spark, d).select("_pos", T.idiom_key("idiom").alias("key"), T.dedup_key("idiom", "meaning").alias("pair"), T.short_id("idiom_", "idiom", "meaning").alias("id"), T.slug("idiom").alias("slug"), T.page_url("https://x/", "idiom").alias("url"))


@query("q_tags_set", f"SELECT _pos, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(lower({s_safe('tags')}), ','), lambda t: trim(t)), lambda t: t <> ''))), '|') AS tags FROM idioms", idioms=IDIOMS_SQL)
def _tags_set(spark, d):
    return idioms(spark, d).select("_pos", F.array_join(F.array_sort(T.tag_list("tags")), "|").alias("tags"))


@query("q_lookups", f"SELECT _pos, {s_case('source', Pub.LICENSES, chr(39) + 'unknown' + chr(39))} AS license, {s_case('lower(idiom_confidence)', L.CONFIDENCE, '0')} AS confidence, {s_case('source', L.PRIORITY_STAGE_2, '0')} AS priority, CASE lower(pos) WHEN 'phrase' THEN true WHEN 'name' THEN false END AS flag FROM idioms", idioms=IDIOMS_SQL)
def _lookups(spark, d):
    flag = T.nullable_bool(F.replace(F.replace(F.lower("pos"), F.lit("phrase"), F.lit("TRUE")), F.lit("name"), F.lit("0")))
    return idioms(spark, d).select("_pos", Pub.license_of("source").alias("license"), S.confidence_score().alias("confidence"), S.source_priority().alias("priority"), flag.alias("flag"))


# --- filters ---------------------------------------------------------------------------------------------------------------------
STRICT_SQL = f"SELECT * FROM idioms WHERE contains({s_safe('idiom')}, ' ') AND {s_count('idiom')} BETWEEN 2 AND 7 AND NOT (upper(idiom) = idiom AND lower(idiom) <> idiom) AND NOT regexp_matches(idiom, '{NOBAR}') AND lower({s_safe('pos')}) NOT IN {s_list(L.STRICT_BAD_POS)} AND (meaning = '' OR NOT {s_match('lower(meaning)', L.STRICT_BAD_MEANINGS)}) AND (lower({s_safe('pos')}) IN {s_list(L.PHRASE_POS)} OR idiom_hint = 1 OR {s_any('lower(' + s_safe('tags') + ')', L.STRICT_TAGS)} OR {s_any('lower(meaning)', L.PRECISE_TAGS)})"


@query("q_strict_filter", f"SELECT _pos, idiom FROM (SELECT *, row_number() OVER (PARTITION BY lower({s_safe('idiom')}), lower({s_safe('meaning')}) ORDER BY _pos) AS r FROM ({STRICT_SQL})) WHERE r = 1", idioms=IDIOMS_SQL)
def _strict_filter(spark, d):
    return Plan.strict_filter(idioms(spark, d)).select("_pos", "idiom")


CLEAN_SQL = f"SELECT *, (CASE WHEN idiom_hint = 1 THEN 3 ELSE 0 END + CASE WHEN lower({s_safe('pos')}) IN {s_list(L.PHRASE_POS)} THEN 3 ELSE 0 END + CASE WHEN {s_any('lower(' + s_safe('tags') + ')', L.CLEAN_SCORE_TAGS)} THEN 2 ELSE 0 END + CASE WHEN {s_safe('example')} <> '' THEN 1 ELSE 0 END) AS score FROM idioms WHERE {s_count('idiom')} BETWEEN 2 AND 7 AND regexp_matches(idiom, '[A-Za-z]') AND NOT regexp_matches(idiom, '{NOBAR}') AND (meaning = '' OR NOT {s_match('lower(meaning)', L.CLEAN_BAD_MEANINGS)}) AND NOT {s_any('lower(' + s_safe('tags') + ')', L.CLEAN_BAD_TAGS)} AND length(regexp_replace({s_safe('idiom')}, '[\\p{{L}}\\p{{N}}\\s''$-]', '', 'g')) <= 2"


@query("q_clean_filter", f"SELECT _pos, idiom, score FROM (SELECT *, row_number() OVER (PARTITION BY idiom ORDER BY score DESC, _pos) AS r FROM ({CLEAN_SQL})) WHERE r = 1", idioms=IDIOMS_SQL)
def _clean_filter(spark, d):
    return Plan.clean(idioms(spark, d)).select("_pos", "idiom", S.clean_score().alias("score"))


@query("q_high_precision", f"SELECT _pos, idiom, score FROM (SELECT *, row_number() OVER (PARTITION BY idiom ORDER BY score DESC, _pos) AS r FROM (SELECT *, (CASE WHEN a THEN 3 ELSE 0 END + CASE WHEN b THEN 3 ELSE 0 END + CASE WHEN c THEN 2 ELSE 0 END + CASE WHEN idiom_hint = 1 THEN 2 ELSE 0 END + CASE WHEN {s_safe('example')} <> '' THEN 1 ELSE 0 END) AS score FROM (SELECT *, {s_any('lower(' + s_safe('tags') + ')', L.PRECISE_TAGS)} AS a, lower({s_safe('pos')}) IN {s_list(L.PHRASE_POS)} AS b, {s_any('lower(meaning)', L.PRECISE_TAGS)} AS c FROM idioms) WHERE a OR b OR c OR idiom_hint = 1)) WHERE r = 1", idioms=IDIOMS_SQL)
def _high_precision(spark, d):
    return Plan.high_precision(idioms(spark, d)).select("_pos", "idiom", S.precision_score().alias("score"))


_G = {"src": f"lower({s_safe('source')})", "tags": f"lower({s_safe('tags')})", "pos": f"lower({s_safe('pos')})"}
STRONG_SQL = f"({_G['src']} IN {s_list(L.CURATED_SOURCES)} OR {s_any(_G['tags'], L.STRONG_TAGS)} OR {_G['pos']} IN {s_list(L.PHRASE_POS)} OR {s_any('lower(meaning)', L.STRONG_TAGS)} OR (lower(idiom_confidence) = 'high' AND source = 'kaikki_wiktionary'))"
BROAD_SQL = f"({STRONG_SQL} OR (source = 'wordnet' AND ({s_any('lower(idiom)', L.PREPOSITIONS)} OR {s_any('lower(meaning)', L.FIGURATIVE_MEANINGS)})) OR {s_any(_G['tags'], L.GLOBAL_TAGS)})"
BASICS_SQL = f"{s_count('idiom')} BETWEEN 2 AND 7 AND regexp_matches(idiom, '[A-Za-z]') AND NOT regexp_matches(idiom, '{NOBAR}') AND (meaning = '' OR NOT {s_match('lower(meaning)', L.GLOBAL_BAD_MEANINGS)})"


@query("q_global_broad", f"SELECT _pos, idiom FROM (SELECT *, row_number() OVER (PARTITION BY lower({s_norm('idiom')}), lower({s_norm('meaning')}) ORDER BY _pos) AS r FROM idioms WHERE {BASICS_SQL} AND {BROAD_SQL}) WHERE r = 1", idioms=IDIOMS_SQL)
def _global_broad(spark, d):
    return Plan.global_filter(sourced(spark, d))[0].select("_pos", "idiom")


GLOBAL_SCORE_SQL = f"CASE WHEN source IN {s_list(L.CURATED_SOURCES)} THEN 4 WHEN source = 'kaikki_wiktionary' THEN 3 WHEN source = 'wordnet' THEN 1 ELSE 0 END + CASE WHEN {s_any(_G['tags'], L.STRONG_TAGS)} THEN 3 ELSE 0 END + CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 2 ELSE 0 END + CASE WHEN {s_safe('example')} <> '' THEN 1 ELSE 0 END"


@query("q_global_high", f"SELECT _pos, idiom, score FROM (SELECT *, row_number() OVER (PARTITION BY lower({s_norm('idiom')}), lower({s_norm('meaning')}) ORDER BY score DESC, _pos) AS r FROM (SELECT *, {GLOBAL_SCORE_SQL} AS score FROM idioms WHERE {BASICS_SQL} AND {STRONG_SQL})) WHERE r = 1", idioms=IDIOMS_SQL)
def _global_high(spark, d):
    return Plan.global_filter(sourced(spark, d))[1].select("_pos", "idiom", S.global_score().alias("score"))


@query("q_explicit_terms", f"SELECT _pos, {s_any('lower(' + s_norm('meaning') + ')', L.EXPLICIT)} OR {s_any('lower(' + s_norm('idiom') + ')', L.EXPLICIT)} AS found, regexp_matches(lower({s_norm('meaning')}), '\\b(?:{'|'.join(sorted(L.EXPLICIT))})\\b') AS as_word FROM idioms", idioms=IDIOMS_SQL)
def _explicit(spark, d):
    return idioms(spark, d).select("_pos", P.explicit("meaning", "idiom").alias("found"), P.explicit("meaning", word_boundary=True).alias("as_word"))


PHRASE_SQL = f"{s_key('idiom')} <> '' AND regexp_matches(idiom, '[A-Za-z]') AND NOT regexp_matches(idiom, '{BAR}') AND {s_count('idiom')} BETWEEN 2 AND 8"
LEN_SCORE = f"CASE WHEN {s_count('idiom')} BETWEEN 2 AND 5 THEN 2 WHEN {s_count('idiom')} BETWEEN 6 AND 8 THEN 1 ELSE 0 END"
CROWD_SQL = f"SELECT *, {LEN_SCORE} + CASE WHEN {s_norm('meaning')} <> '' THEN 3 ELSE 0 END + CASE WHEN {s_count('example')} >= 3 THEN 2 ELSE 0 END + CASE WHEN {s_any(_G['tags'], L.CROWD_TAGS)} THEN 2 ELSE 0 END + CASE WHEN {s_norm('example')} <> '' AND contains(lower({s_norm('example')}), {s_key('idiom')}) THEN 1 ELSE 0 END - CASE WHEN {s_key('idiom')} IN {s_list(L.CROWD_WEAK)} THEN 3 ELSE 0 END - CASE WHEN {s_count('meaning')} < 4 THEN 1 ELSE 0 END AS score FROM idioms WHERE {PHRASE_SQL} AND meaning <> '' AND NOT {s_match(s_key('meaning'), L.CROWD_BAD_MEANINGS)} AND NOT {s_any('lower(idiom)', L.EXPLICIT)} AND NOT {s_any('lower(meaning)', L.EXPLICIT)} AND NOT {s_any('lower(' + s_norm('example') + ')', L.EXPLICIT)}"


@query("q_crowd_slang", f"SELECT _pos, idiom, score FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('idiom')} ORDER BY score DESC, {s_norm('meaning')}, {s_norm('example')}, _pos) AS r FROM ({CROWD_SQL})) WHERE r = 1", idioms=IDIOMS_SQL)
def _crowd(spark, d):
    return Plan.crowd_slang(sourced(spark, d)).select("_pos", "idiom", S.crowd_score().alias("score"))


TAGSET = f"list_filter(list_transform(string_split({_G['tags']}, ','), lambda t: trim(t)), lambda t: t <> '')"
SLANG_STRONG = f"list_has_any({TAGSET}, {s_arr(L.SLANG_STRONG_TAGS)})"


@query("q_dictionary_slang", f"SELECT _pos, idiom, score FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('idiom')} ORDER BY score DESC, {s_norm('meaning')}, {s_norm('example')}, _pos) AS r FROM (SELECT *, {LEN_SCORE} + CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 3 WHEN {_G['pos']} IN ('verb', 'adjective', 'adverb', 'noun', 'interjection') THEN 1 ELSE 0 END + CASE WHEN {s_norm('meaning')} <> '' THEN 3 ELSE 0 END + CASE WHEN {s_count('example')} >= 3 THEN 2 ELSE 0 END + CASE WHEN {s_any(_G['tags'], ('slang', 'informal', 'colloquial', 'internet'))} THEN 3 ELSE 0 END + CASE WHEN {s_any(_G['tags'], ('idiomatic', 'figurative', 'idiom', 'sarcastic', 'humorous', 'meme'))} THEN 2 ELSE 0 END + CASE WHEN {s_any('lower(meaning)', L.FIGURATIVE_MEANINGS)} THEN 2 ELSE 0 END + CASE WHEN NOT {s_prefix(s_key('idiom'), L.PRONOUN_STARTS)} THEN 1 ELSE 0 END AS score FROM idioms WHERE {PHRASE_SQL} AND meaning <> '' AND NOT {s_match(s_key('meaning'), L.SLANG_CLEAN_BAD_MEANINGS)} AND NOT {s_any('lower(idiom)', L.EXPLICIT)} AND NOT {s_any('lower(meaning)', L.EXPLICIT)} AND NOT {s_any('lower(' + s_norm('example') + ')', L.EXPLICIT)} AND NOT ({s_key('idiom')} IN {s_list(L.SLANG_WEAK)} AND NOT ({SLANG_STRONG} AND {s_any('lower(meaning)', L.FIGURATIVE_MEANINGS)})) AND NOT (NOT ({SLANG_STRONG} OR {s_any('lower(meaning)', (*L.FIGURATIVE_MEANINGS, 'sarcastic', 'humorous'))} OR {_G['pos']} IN {s_list(L.PHRASE_POS)}) AND ({s_any('lower(meaning)', L.GENERIC_WORDS)} OR {s_count('meaning')} <= 3 OR ({s_count('idiom')} <= 3 AND {s_count('meaning')} <= 6))) QUALIFY row_number() OVER (PARTITION BY {s_key('idiom')}, {s_key('meaning')}, {s_norm('example')} ORDER BY _pos) = 1)) WHERE r = 1", idioms=IDIOMS_SQL)
def _dictionary_slang(spark, d):
    return Plan.dictionary_slang(sourced(spark, d)).select("_pos", "idiom", S.slang_clean_score().alias("score"))


WORDS_SQL = "regexp_extract_all(lower(regexp_replace({0}, '\\s+', ' ', 'g')), '[A-Za-z]+(?:''[A-Za-z]+)?')"


def s_example_score(line: str, phrase: str, ideal=(5, 18), fair=(4, 24)) -> str:
    n = f"len({WORDS_SQL.format(line)})"
    return f"(CASE WHEN {n} BETWEEN {ideal[0]} AND {ideal[1]} THEN 3 WHEN {n} BETWEEN {fair[0]} AND {fair[1]} THEN 2 ELSE 1 END + CASE WHEN {line} <> '' THEN 2 ELSE 0 END + CASE WHEN {phrase} <> '' AND contains(lower({line}), {phrase}) THEN 2 ELSE 0 END - CASE WHEN upper({line}) = {line} AND lower({line}) <> {line} THEN 2 ELSE 0 END - len(regexp_extract_all({line}, '[<>\\[\\]{{}}_=*\\\\|]')))".replace("{{}}", "{}")


SHAPE_SQL = f"(CASE WHEN len(toks) IN (3, 4) THEN 2 WHEN len(toks) = 5 THEN 1 ELSE 0 END + CASE WHEN {LAST} IN {s_list(L.PARTICLES)} THEN 2 ELSE 0 END + CASE WHEN {s_has(L.CUES)} THEN 2 ELSE 0 END + CASE WHEN len(list_distinct({CONTENT})) >= 3 THEN 1 ELSE 0 END + CASE WHEN {s_match('k', L.MODERN_STRONG_PATTERNS)} THEN 3 ELSE 0 END)"
EX_SQL = s_example_score("ex", "k")
MODERN_BASE = f"SELECT *, {s_key('idiom')} AS k, {s_norm('example')} AS ex, string_split({s_key('idiom')}, ' ') AS toks FROM idioms"
DIALOGUE_SHAPE = f"k NOT IN {{blocked}} AND NOT {s_prefix('k', L.BLOCKED_STARTS)} AND NOT regexp_matches(k, '{BAR.replace('{', '{{').replace('}', '}}')}') AND regexp_matches(k, '[A-Za-z]') AND len(toks) BETWEEN 3 AND 5 AND toks[1] NOT IN {s_list(L.PRONOUNS)} AND len({CONTENT}) >= 2 AND NOT {{literal}} AND NOT ({LAST} IN {s_list(L.STOPWORDS)} AND {LAST} NOT IN {s_list(L.PARTICLES)}) AND len(list_filter({CONTENT}, lambda t: list_contains({{weak}}, t))) < 2"
MODERN_PHRASE = DIALOGUE_SHAPE.format(blocked=s_list(L.MODERN_WEAK_PHRASES), literal=s_prefix("k", L.LITERAL_STARTS), weak=s_arr(L.WEAK_WORDS))
STRONG_PATTERN = s_match("k", L.MODERN_STRONG_PATTERNS)
MODERN_TAG = s_any(_G["tags"], L.MODERN_TAGS)


@query("q_modern_keep", f"SELECT _pos, shape, ex_score, broad, high FROM (SELECT *, ({MODERN_PHRASE} AND (meaning = '' OR NOT bad) AND (meaning <> '' OR ex <> '') AND CASE WHEN source IN {s_list(L.DICTIONARY_SOURCES)} THEN true WHEN source = 'opensubtitles_dialogue' THEN {STRONG_PATTERN} OR (shape >= 4 AND ex_score >= 4) ELSE shape >= 3 OR {MODERN_TAG} OR {_G['pos']} IN {s_list(L.PHRASE_POS)} END) AS broad, CASE WHEN meaning <> '' AND bad THEN false ELSE (meaning <> '' AND ((source IN {s_list(L.DICTIONARY_SOURCES)} AND (shape >= 3 OR {MODERN_TAG} OR {_G['pos']} IN {s_list(L.PHRASE_POS)})) OR (lower(idiom_confidence) IN ('high', 'medium') AND (shape >= 4 OR {MODERN_TAG})))) OR (source = 'opensubtitles_dialogue' AND (({STRONG_PATTERN} AND ex_score >= 4) OR (shape >= 6 AND ex_score >= 5))) END AS high FROM (SELECT *, {SHAPE_SQL} AS shape, {EX_SQL} AS ex_score, {s_match(s_key('meaning'), L.MODERN_BAD_MEANINGS)} AS bad FROM base))", idioms=IDIOMS_SQL, base=MODERN_BASE)
def _modern_keep(spark, d):
    return sourced(spark, d).select("_pos", S.shape_score("idiom").alias("shape"), S.example_score("example", T.idiom_key("idiom")).alias("ex_score"), P.broad_keep().alias("broad"), P.high_quality_keep().alias("high"))


@query("q_candidate_clean", f"SELECT _pos, shape_ok, literal FROM (SELECT *, ({DIALOGUE_SHAPE.format(blocked=s_list(L.WEAK_PHRASES), literal=s_prefix('k', L.LITERAL_STARTS), weak=s_arr(L.WEAK_WORDS))} AND NOT regexp_matches(k, '{L.SCAFFOLDS}') AND len({WORDS_SQL.format('k')}) BETWEEN 3 AND 5) AS shape_ok, (NOT {s_match('k', L.STRONG_PATTERNS)} AND (k IN {s_list(L.WEAK_PHRASES)} OR {s_prefix('k', L.BLOCKED_STARTS)} OR {s_prefix('k', L.LITERAL_STARTS)} OR regexp_matches(k, '{L.SCAFFOLDS}') OR len({CONTENT}) < 2 OR (NOT {s_has(L.CUES)} AND {LAST} NOT IN {s_list(L.PARTICLES)} AND len({CONTENT}) <= 2) OR {s_example_score('lower(ex)', 'k')} <= 1)) AS literal FROM base)", idioms=IDIOMS_SQL, base=MODERN_BASE)
def _candidate_clean(spark, d):
    return idioms(spark, d).select("_pos", P.candidate_phrase("idiom").alias("shape_ok"), P.candidate_too_literal("idiom", "example").alias("literal"))


# --- phrase mining -----------------------------------------------------------------------------------------------------------------
GRAMS_SQL = (
    "SELECT doc_id, line_no, line, n, s, array_to_string(toks[s + 1 : s + n], ' ') AS k, toks[s + 1 : s + n] AS toks FROM (SELECT doc_id, line_no, line, toks, n, unnest(range(len(toks) - n + 1)) AS s FROM (SELECT doc_id, line_no, line, toks, unnest([3, 4, 5]) AS n FROM "
    "(SELECT doc_id, line_no, line, regexp_extract_all(lower(line), '[A-Za-z]+(?:''[A-Za-z]+)?') AS toks FROM (SELECT doc_id, line_no, " + s_norm("text") + " AS line FROM lines) WHERE length(line) BETWEEN 8 AND 180 AND regexp_matches(line, '[A-Za-z]') AND len(regexp_extract_all(line, '[<>\\[\\]{}_=*\\\\|]')) <= 2) WHERE len(toks) BETWEEN 3 AND 25) WHERE len(toks) >= n)"
)
OCCURRENCES_SQL = "SELECT * FROM grams WHERE " + DIALOGUE_SHAPE.format(blocked=s_list(L.MINING_BLOCKED), literal=s_prefix("k", L.MINING_LITERAL_STARTS), weak=s_arr(L.MINING_WEAK_WORDS)) + f" AND NOT regexp_matches(k, '{L.MINING_SCAFFOLDS}') AND (n > 3 OR {s_has(L.MINING_CUES)} OR {LAST} IN {s_list(L.PARTICLES)})"
_MINING = {"lines": LINES_SQL, "grams": GRAMS_SQL, "occ": OCCURRENCES_SQL, "counts": "SELECT k, count(DISTINCT (doc_id, line_no)) AS c FROM occ GROUP BY k HAVING count(DISTINCT (doc_id, line_no)) >= 3"}


@query("q_phrase_mining", f"SELECT k AS phrase, c AS frequency_count, line AS example, len(toks) AS token_length, len(list_distinct({CONTENT})) + CASE WHEN {s_has(L.MINING_CUES)} THEN 2 ELSE 0 END + CASE WHEN {LAST} IN {s_list(L.PARTICLES)} THEN 2 ELSE 0 END + CASE WHEN len({CONTENT}) >= 3 THEN 1 ELSE 0 END AS lexical_score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY es DESC, a) AS b FROM (SELECT *, {s_example_score('line', 'k', (5, 16), (4, 20))} AS es FROM (SELECT occ.*, c, row_number() OVER (PARTITION BY occ.k ORDER BY doc_id, line_no, n, s) AS a FROM occ JOIN counts ON occ.k = counts.k) WHERE a <= 20)) WHERE b = 1", **_MINING)
def _phrase_mining(spark, d):
    return M.ordered_phrases(M.mine_phrases(lines(spark, d), 3))


@query("q_top_candidates", "SELECT k AS phrase, count(DISTINCT (doc_id, line_no)) AS frequency_count FROM occ GROUP BY k ORDER BY 2 DESC, min((doc_id, line_no, n, s)) LIMIT 30", **{k: v for k, v in _MINING.items() if k != "counts"})
def _top_candidates(spark, d):
    return M.top_candidates(lines(spark, d))


@query("q_mining_statistics", "SELECT (SELECT count(*) FROM lines) AS lines, (SELECT count(*) FROM occ) AS structural_passes, (SELECT count(DISTINCT k) FROM occ) AS candidates, (SELECT count(*) FROM counts) AS frequent_phrases, (SELECT round(coalesce(avg(c), 0), 4) FROM counts) AS mean_frequency", **_MINING)
def _mining_statistics(spark, d):
    return M.mining_statistics(lines(spark, d), 3).drop("good_lines")


_DIALOGUE = f"SELECT c._pos AS idiom, '' AS meaning_en, m.example, 'opensubtitles_dialogue' AS source, 'dialogue' AS source_type FROM ({ORACLES['q_candidate_clean'].replace(IDIOMS_SQL, 'SELECT phrase AS _pos, phrase AS idiom, example FROM mined')}) c JOIN mined m ON c._pos = m.phrase WHERE shape_ok AND NOT literal"


@query("q_dialogue_candidates", _DIALOGUE, mined=ORACLES["q_phrase_mining"])
def _dialogue_candidates(spark, d):
    return Plan.dialogue_candidates(lines(spark, d), 3).select("idiom", "meaning_en", "example", "source", "source_type")


# --- deduplication -------------------------------------------------------------------------------------------------------------------
@query("q_dedup_pair", f"SELECT min(_pos) AS _pos FROM idioms GROUP BY lower({s_norm('idiom')}), lower({s_norm('meaning')})", idioms=IDIOMS_SQL)
def _dedup_pair(spark, d):
    return D.first_row(idioms(spark, d), [T.lower_norm("idiom"), T.lower_norm("meaning")]).select("_pos")


MERGE1 = f"CASE WHEN {s_norm('example')} <> '' THEN 4 ELSE 0 END + {s_case('lower(idiom_confidence)', L.CONFIDENCE, '0').join(['(', ')'])} * 3 + ({s_case('source', L.PRIORITY_STAGE_1, '0')}) * 2 + CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 2 ELSE 0 END + CASE WHEN {s_any(_G['tags'], L.MERGE_TAGS)} THEN 1 ELSE 0 END"
MERGE2 = f"CASE WHEN len(w) IN (3, 4) THEN 2 WHEN len(w) = 5 THEN 1 ELSE 0 END + CASE WHEN w[len(w)] IN {s_list(L.PARTICLES)} THEN 2 ELSE 0 END + CASE WHEN {s_has(L.CUES, 'w')} THEN 2 ELSE 0 END + CASE WHEN {s_norm('example')} <> '' THEN 4 ELSE 0 END + CASE WHEN {s_norm('meaning')} <> '' THEN 5 ELSE 1 END + ({s_case('lower(idiom_confidence)', L.CONFIDENCE, '0')}) * 3 + ({s_case('source', L.PRIORITY_STAGE_2, '0')}) * 3 + CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 2 ELSE 0 END + CASE WHEN {s_any(_G['tags'], L.MERGE_TAGS)} THEN 2 ELSE 0 END"
BEST = f"({s_case('source', L.PRIORITY_STAGE_2, '0')}) * 3 + ({s_case('lower(idiom_confidence)', L.CONFIDENCE, '0')}) * 2 + {SHAPE_SQL} + {EX_SQL} + CASE WHEN {s_norm('meaning')} <> '' THEN 5 ELSE 0 END + CASE WHEN ex <> '' THEN 4 ELSE 0 END + CASE WHEN {MODERN_TAG} THEN 2 ELSE 0 END + CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 2 ELSE 0 END + CASE WHEN {STRONG_PATTERN} THEN 3 ELSE 0 END"
CANDIDATE = f"{EX_SQL} + CASE WHEN len(list_distinct({CONTENT})) >= 3 THEN 2 WHEN len(list_distinct({CONTENT})) = 2 THEN 1 ELSE 0 END + CASE WHEN len(toks) IN (3, 4) THEN 2 WHEN len(toks) = 5 THEN 1 ELSE 0 END + CASE WHEN {s_match('k', L.STRONG_PATTERNS)} THEN 5 ELSE 0 END + CASE WHEN {s_has(L.CUES)} THEN 3 ELSE 0 END + CASE WHEN {LAST} IN {s_list(L.PARTICLES)} THEN 2 ELSE 0 END + CASE WHEN contains({_G['tags']}, 'repeated_ngram') THEN 1 ELSE 0 END"
PRE_LLM = f"CASE WHEN contains(source, 'wiktionary') THEN 4 WHEN contains(source, 'urban') THEN 3 WHEN contains(source, 'opensubtitles') THEN 1 ELSE 0 END * 3 + ({s_case('lower(idiom_confidence)', L.CONFIDENCE, '0')}) * 2 + CASE WHEN {s_norm('meaning')} <> '' THEN 5 ELSE 0 END + CASE WHEN ex <> '' THEN 1 ELSE 0 END + CASE WHEN {s_any(_G['tags'], ('idiomatic', 'figurative', 'slang', 'colloquial'))} THEN 2 ELSE 0 END + CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 1 ELSE 0 END"
SLANG_B = f"CASE WHEN {_G['pos']} IN {s_list(L.PHRASE_POS)} THEN 3 ELSE 0 END + CASE WHEN {s_any(_G['tags'], ('slang', 'informal', 'colloquial', 'internet'))} THEN 3 ELSE 0 END + CASE WHEN {s_any(_G['tags'], L.STRONG_TAGS)} THEN 2 ELSE 0 END + CASE WHEN {s_any('lower(meaning)', L.FIGURATIVE_MEANINGS)} THEN 2 ELSE 0 END + CASE WHEN ex <> '' THEN 1 ELSE 0 END + CASE WHEN {s_count('idiom')} BETWEEN 2 AND 5 THEN 1 ELSE 0 END"


@query("q_scores", f"SELECT _pos, {MERGE1} AS merge_1, {MERGE2} AS merge_2, {BEST} AS best, {CANDIDATE} AS candidate, {PRE_LLM} AS pre_llm, {SLANG_B} AS slang FROM (SELECT *, {WORDS_SQL.format('idiom')} AS w FROM base)", idioms=IDIOMS_SQL, base=MODERN_BASE)
def _scores(spark, d):
    return sourced(spark, d).select("_pos", S.merge_score_1().alias("merge_1"), S.merge_score_2().alias("merge_2"), S.best_row_score().alias("best"), S.candidate_score().alias("candidate"), S.before_enrichment_score("meaning_en").alias("pre_llm"), S.slang_score().alias("slang"))


@query("q_merge_best", f"SELECT _pos FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('idiom')}, {s_key('meaning')} ORDER BY sc DESC, _pos) AS r FROM (SELECT *, {MERGE1} AS sc FROM idioms)) WHERE r = 1", idioms=IDIOMS_SQL)
def _merge_best(spark, d):
    half = sourced(spark, d)
    return Plan.merge_stage_1(half.where("_pos % 2 = 0"), half.where("_pos % 2 = 1")).select("_pos")


@query("q_unique_pairs_plus_best", f"SELECT _pos FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sc DESC, m, _pos) AS b FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, m ORDER BY sc DESC, _pos) AS a FROM (SELECT *, {s_key('meaning')} AS m, {BEST} AS sc FROM base)) WHERE a = 1)) WHERE m <> '' OR b = 1", idioms=IDIOMS_SQL, base=MODERN_BASE)
def _unique_pairs(spark, d):
    return D.unique_pairs_plus_best(sourced(spark, d), T.idiom_key("idiom"), T.idiom_key("meaning_en"), S.best_row_score()).select("_pos")


@query("q_priority_dedup", "SELECT _pos FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(idiom)) ORDER BY CASE source WHEN 'wordnet' THEN 1 WHEN 'phrasefinder' THEN 2 ELSE 3 END, _pos) AS r FROM idioms) WHERE r = 1", idioms=IDIOMS_SQL)
def _priority(spark, d):
    return D.by_priority(idioms(spark, d), [F.lower(T.safe("idiom"))], "source", ["wordnet", "phrasefinder"]).select("_pos")


@query("q_richest_row", "SELECT _pos FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY (example IS NOT NULL)::INT + (tags IS NOT NULL)::INT + (pos IS NOT NULL)::INT DESC, _pos) AS r FROM idioms) WHERE r = 1", idioms=IDIOMS_SQL)
def _richest(spark, d):
    return D.richest_row(idioms(spark, d), ["brand"], ["example", "tags", "pos"]).select("_pos")


@query("q_duplicate_count", "SELECT count(*) - count(DISTINCT text) AS duplicates FROM documents")
def _duplicates(spark, d):
    return D.duplicate_count(table(spark, d, "documents"), ["text"])


# --- joins, sets ---------------------------------------------------------------------------------------------------------------------
def _halves(spark, d):
    rows = idioms(spark, d).withColumn("key", T.idiom_key("idiom"))
    return rows.where("size < 20"), rows.where("size >= 20")


_HALF = {"idioms": IDIOMS_SQL, "a": f"SELECT *, {s_key('idiom')} AS key FROM idioms WHERE size < 20", "b": f"SELECT *, {s_key('idiom')} AS key FROM idioms WHERE size >= 20"}


@query("q_anti_inventory", "SELECT _pos FROM a WHERE key NOT IN (SELECT key FROM b)", **_HALF)
def _anti(spark, d):
    a, b = _halves(spark, d)
    return J.not_in(a, b.select("key"), "key").select("_pos")


@query("q_semi_inventory", "SELECT _pos FROM a WHERE key IN (SELECT key FROM b)", **_HALF)
def _semi(spark, d):
    a, b = _halves(spark, d)
    return J.only_in(a, b.select("key"), "key").select("_pos")


@query("q_rest_of_broad", "SELECT _pos FROM a UNION ALL SELECT _pos FROM b WHERE key NOT IN (SELECT key FROM a)", **_HALF)
def _rest(spark, d):
    a, b = _halves(spark, d)
    return J.rest_of_broad(a, b, ["key"]).select("_pos")


@query("q_overlap_counts", "SELECT 'idioms' AS overlap, count(*) AS n FROM (SELECT key FROM a INTERSECT SELECT key FROM b) UNION ALL SELECT 'pairs', count(*) FROM (SELECT key, meaning FROM a INTERSECT SELECT key, meaning FROM b)", **_HALF)
def _overlap(spark, d):
    a, b = _halves(spark, d)
    return St.overlap_counts(a, b, {"idioms": ["key"], "pairs": ["key", "meaning"]})


@query("q_union_keys", f"SELECT DISTINCT {s_key('idiom')} AS key FROM idioms", idioms=IDIOMS_SQL)
def _union_keys(spark, d):
    a, b = _halves(spark, d)
    return W.union_keys(a.select("key"), b.select("key"))


@query("q_source_union_align", "SELECT _pos, idiom, brand, NULL AS extra FROM a UNION ALL SELECT _pos, idiom, NULL, size FROM b", **_HALF)
def _align(spark, d):
    a, b = _halves(spark, d)
    return Sch.align_union(a.select("_pos", "idiom", "brand"), b.select("_pos", "idiom", F.col("size").alias("extra")))


JACCARD = "len(list_intersect({0}, {1}))::DOUBLE / len(list_distinct(list_concat({0}, {1})))"
WSET = "list_distinct(regexp_extract_all({0}, '[A-Za-z0-9]+(?:''[A-Za-z0-9]+)?'))"
STATUS_VIEWS = _HALF | {
    "n": f"SELECT *, {s_key('meaning')} AS m, {s_key('example')} AS e FROM a", "mn": f"SELECT *, {s_key('meaning')} AS m, {s_key('example')} AS e FROM b",
    "near": f"SELECT n._pos, min_by(mn.m, mn._pos) AS hit FROM n JOIN mn ON n.key = mn.key WHERE n.m <> '' AND mn.m <> '' AND (n.m = mn.m OR {JACCARD.format(WSET.format('n.m'), WSET.format('mn.m'))} >= 0.85) GROUP BY n._pos",
}


@query("q_match_status", "SELECT n._pos, CASE WHEN n.key = '' THEN 'remove_missing_idiom' WHEN EXISTS (SELECT 1 FROM mn WHERE mn.key = n.key AND mn.m = n.m AND mn.e = n.e) THEN 'remove_exact_duplicate_of_main' WHEN EXISTS (SELECT 1 FROM mn WHERE mn.key = n.key AND mn.m = n.m) THEN 'remove_duplicate_idiom_meaning_of_main' WHEN EXISTS (SELECT 1 FROM mn WHERE mn.key = n.key) AND n.m = '' THEN 'remove_existing_idiom_without_new_meaning' WHEN NOT EXISTS (SELECT 1 FROM mn WHERE mn.key = n.key) THEN 'keep_new_idiom' WHEN near.hit IS NOT NULL THEN 'remove_near_duplicate_meaning_of_main' ELSE 'keep_new_meaning_for_existing_idiom' END AS status FROM n LEFT JOIN near ON n._pos = near._pos", **STATUS_VIEWS)
def _match_status(spark, d):
    a, b = _halves(spark, d)
    return J.match_status(a, b, with_ratio=False).select("_pos", "status")


@query("q_near_duplicates")
def _near(spark, d):
    a, b = _halves(spark, d)
    return J.match_status(a, b).select("_pos", "status", "matched_meaning")


@query("q_metadata_fill", "SELECT _pos, coalesce(meaning, f) AS meaning FROM meta LEFT JOIN (SELECT src AS s, max(meaning) AS f FROM meta GROUP BY src) ON src = s", meta=META_SQL)
def _metadata_fill(spark, d):
    rows = metadata(spark, d)
    return J.fill_from(rows, rows.groupBy("src").agg(F.max("meaning").alias("f")), "src", {"meaning": "f"}).select("_pos", "meaning")


# --- whole pipelines -------------------------------------------------------------------------------------------------------------------
def on_view(sql: str, view: str) -> str:
    """A stage's SQL over another view than ``idioms``."""
    body = sql.removeprefix(f"WITH idioms AS ({IDIOMS_SQL})").lstrip()
    body = f"WITH {body[1:]}" if body.startswith(",") else body
    return re.sub(r"\bidioms\b", view, body)


def kept_by(name: str, view: str) -> str:
    """The rows of a view that a stage's query keeps."""
    return f"SELECT * FROM {view} WHERE _pos IN (SELECT _pos FROM ({on_view(ORACLES[name], view)}))"


_CORE = {
    "idioms": IDIOMS_SQL,
    "senses": "SELECT * EXCLUDE r0 FROM (SELECT *, row_number() OVER (PARTITION BY lower(idiom), lower(meaning) ORDER BY _pos) AS r0 FROM idioms) WHERE r0 = 1",
    "strict": kept_by("q_strict_filter", "senses"),
    "cleaned": kept_by("q_clean_filter", "strict"),
    "precise": kept_by("q_high_precision", "cleaned"),
    "sources": "SELECT * REPLACE ('kaikki_wiktionary' AS source, 'high' AS idiom_confidence) FROM precise UNION ALL SELECT * REPLACE ('wordnet' AS source, 'medium' AS idiom_confidence, _pos + 1000000000 AS _pos) FROM idioms WHERE _pos % 3 = 0",
    "merged": f"SELECT * EXCLUDE r1 FROM (SELECT *, row_number() OVER (PARTITION BY lower({s_safe('idiom')}), lower({s_safe('meaning')}) ORDER BY _pos) AS r1 FROM sources) WHERE r1 = 1",
}


@query("q_core_pipeline", f"SELECT 'broad' AS kind, _pos FROM ({kept_by('q_global_broad', 'merged')}) UNION ALL SELECT 'high', _pos FROM ({kept_by('q_global_high', 'merged')})", **_CORE)
def _core_pipeline(spark, d):
    """Dictionary senses and lexical rows through all filters to the broad and the high-precision set."""
    rows = idioms(spark, d)
    senses = rows.withColumn("_pos", F.struct(F.lit(0).alias("branch"), F.col("_pos").cast("long").alias("place"), F.lit(0).alias("sense")))
    sets = Plan.core_of_senses(senses, sourced(spark, d).where("_pos % 3 = 0"))
    place = F.col("_pos.branch") * 1000000000 + F.col("_pos.place")
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), place.alias("_pos")) for kind, df in zip(("broad", "high"), sets, strict=True)])


_MODERN = {
    "idioms": IDIOMS_SQL,
    "crowd_in": "SELECT * FROM idioms WHERE _pos % 3 = 0", "crowd": kept_by("q_crowd_slang", "crowd_in"),
    "slang_in": "SELECT * FROM idioms WHERE _pos % 3 = 1", "slang": kept_by("q_dictionary_slang", "slang_in"),
    "first_in": "SELECT * FROM crowd UNION ALL SELECT * FROM slang", "first_merge": kept_by("q_merge_best", "first_in"),
    "second_in": "SELECT * FROM first_merge UNION ALL SELECT * FROM idioms WHERE _pos % 3 = 2",
    "second_merge": f"SELECT * EXCLUDE (w, r2) FROM (SELECT *, row_number() OVER (PARTITION BY {s_key('idiom')}, {s_key('meaning')} ORDER BY {MERGE2} DESC, _pos) AS r2 FROM (SELECT *, {WORDS_SQL.format('idiom')} AS w FROM ({on_view(MODERN_BASE, 'second_in')}))) WHERE r2 = 1",
    "second": "SELECT * FROM second_in WHERE _pos IN (SELECT _pos FROM second_merge)",
    "broad_in": f"SELECT * FROM second WHERE _pos IN (SELECT _pos FROM ({on_view(ORACLES['q_modern_keep'], 'second')}) WHERE broad)",
    "broad_set": kept_by("q_unique_pairs_plus_best", "broad_in"),
    "high_in": f"SELECT * FROM broad_set WHERE _pos IN (SELECT _pos FROM ({on_view(ORACLES['q_modern_keep'], 'broad_set')}) WHERE high)",
}


@query("q_modern_pipeline", f"SELECT 'broad' AS kind, _pos FROM broad_set UNION ALL SELECT 'high', _pos FROM ({kept_by('q_unique_pairs_plus_best', 'high_in')})", **_MODERN)
def _modern_pipeline(spark, d):
    """Three modern sources, cleaned each its own way and merged in two stages, to the broad and the high-quality set."""
    rows = sourced(spark, d)
    merged = Plan.merge_stage_1(Plan.crowd_slang(rows.where("_pos % 3 = 0")), Plan.dictionary_slang(rows.where("_pos % 3 = 1")))
    sets = Plan.modern_filter(Plan.merge_stage_2(merged, rows.where("_pos % 3 = 2")))
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), "_pos") for kind, df in zip(("broad", "high"), sets, strict=True)])


# --- windows, samples, splits ----------------------------------------------------------------------------------------------------------
@query("q_ffill_bfill", "SELECT _pos, coalesce(last_value(meaning IGNORE NULLS) OVER (PARTITION BY src ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(meaning IGNORE NULLS) OVER (PARTITION BY src ORDER BY _pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS meaning FROM meta", meta=META_SQL)
def _fill(spark, d):
    return W.fill_both_ways(metadata(spark, d), "src", "meaning").select("_pos", "meaning")


@query("q_cumcount", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS rank FROM conversations")
def _cumcount(spark, d):
    return W.numbered(table(spark, d, "conversations"), ["conv_id", "role"], ["turn"], start=0).select("conv_id", "turn", "rank")


@query("q_pair_ids", "SELECT _pos, CASE WHEN ok THEN concat(idiom_id, '_pair_', n) END AS minimal_pair_id FROM enriched LEFT JOIN (SELECT idiom_id AS i, context_type AS c, true AS ok, row_number() OVER (ORDER BY idiom_id, context_type) AS n FROM (SELECT idiom_id, context_type FROM enriched GROUP BY ALL HAVING count(*) FILTER (example_usage_label = 'idiomatic') > 0 AND count(*) FILTER (example_usage_label = 'literal') > 0)) ON idiom_id = i AND context_type = c", enriched=ENRICHED_SQL)
def _pair_ids(spark, d):
    label = F.col("example_usage_label")
    return W.pair_ids(enriched(spark, d), ["idiom_id", "context_type"], (F.count_if(label == "idiomatic") > 0) & (F.count_if(label == "literal") > 0)).select("_pos", "minimal_pair_id")


_FINAL = {"enriched": ENRICHED_SQL, "rows": f"SELECT *, {s_safe('idiom_in_example')} AS e, CASE lower(is_example_idiom) WHEN 'true' THEN true WHEN 'false' THEN false WHEN '0' THEN false END AS flag FROM enriched"}
_V2 = {"kept": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idiom_id, context_type, example_usage_label ORDER BY (trim(idiom_in_example) <> '')::INT DESC, length(e) DESC, (coalesce(idiom_surface, '') <> '')::INT DESC, _pos) AS a FROM rows WHERE row_type = 'main_example' AND example_usage_label IN ('idiomatic', 'literal')) WHERE a = 1", "pairs": "SELECT idiom_id AS i, context_type AS c, row_number() OVER (ORDER BY idiom_id, context_type) AS n FROM kept GROUP BY 1, 2 HAVING count(DISTINCT example_usage_label) = 2"}


@query("q_finalize", f"SELECT _pos, row_type, example_usage_label, example_usage_label AS expected_label, example_usage_label = 'idiomatic' AS is_example_idiom, concat(i, '_pair_', n) AS minimal_pair_id, false AS is_adversarial_example FROM kept JOIN pairs ON idiom_id = i AND context_type = c UNION ALL SELECT _pos, row_type, example_usage_label, example_usage_label, example_usage_label = 'idiomatic', NULL, false FROM kept WHERE (idiom_id, context_type) NOT IN (SELECT (i, c) FROM pairs) UNION ALL SELECT _pos, concat('adversarial_example_', r), example_usage_label, CASE WHEN expected_label IN {s_list(L.LABELS)} THEN expected_label ELSE 'borderline' END, flag, NULL, true FROM (SELECT *, row_number() OVER (PARTITION BY idiom_id ORDER BY (e <> '')::INT DESC, length(e) DESC, adversarial_type, _pos) AS r FROM rows WHERE contains(row_type, 'adversarial')) WHERE r <= 2", **_FINAL, **_V2)
def _finalize(spark, d):
    return Pub.finalize(enriched(spark, d)).select("_pos", "row_type", "example_usage_label", "expected_label", "is_example_idiom", "minimal_pair_id", "is_adversarial_example")


@query("q_finalize_v1", "SELECT _pos, row_type, example_usage_label AS expected_label, concat(idiom_id, '_pair_', n) AS minimal_pair_id FROM rows JOIN (SELECT idiom_id AS i, context_type AS c, row_number() OVER (ORDER BY idiom_id, context_type) AS n FROM rows WHERE row_type = 'main_example' GROUP BY 1, 2) ON idiom_id = i AND context_type = c WHERE row_type = 'main_example' UNION ALL SELECT _pos, row_type, expected_label, NULL FROM rows WHERE row_type = 'other' UNION ALL SELECT _pos, concat('adversarial_example_', r), expected_label, NULL FROM (SELECT *, row_number() OVER (PARTITION BY idiom_id ORDER BY adversarial_type, e, _pos) AS r FROM rows WHERE contains(row_type, 'adversarial')) WHERE r <= 2", **_FINAL)
def _finalize_v1(spark, d):
    return Pub.finalize(enriched(spark, d), version="v1").select("_pos", "row_type", "expected_label", "minimal_pair_id")


@query("q_finalize_generated", "SELECT _pos, concat('adversarial_example_', r) AS row_type, expected_label, NULL AS minimal_pair_id FROM (SELECT *, row_number() OVER (PARTITION BY idiom_id ORDER BY e, _pos) AS r FROM rows WHERE contains(row_type, 'adversarial')) WHERE r <= 2 UNION ALL SELECT _pos, row_type, example_usage_label, concat(idiom_id, '_pair_', n) FROM rows JOIN (SELECT idiom_id AS i, context_type AS c, row_number() OVER (ORDER BY idiom_id, context_type) AS n FROM rows WHERE row_type = 'main_example' GROUP BY 1, 2) ON idiom_id = i AND context_type = c WHERE row_type = 'main_example' UNION ALL SELECT _pos, row_type, expected_label, NULL FROM rows WHERE NOT contains(row_type, 'adversarial') AND row_type <> 'main_example'", **_FINAL)
def _finalize_generated(spark, d):
    return Pub.finalize(enriched(spark, d), version="generated").select("_pos", "row_type", "expected_label", "minimal_pair_id")


@query("q_split_by_key", "SELECT doc_id, CASE WHEN (('0x' || substr(md5(text), 1, 4))::INT % 100) < 80 THEN 'train' ELSE 'test' END AS split FROM documents")
def _split(spark, d):
    return W.split_by_key(table(spark, d, "documents"), "text").select("doc_id", "split")


@query("q_split_overlap", "SELECT 0 AS overlap")
def _split_overlap(spark, d):
    return W.split_overlap(W.split_by_key(table(spark, d, "documents"), "text"), "text")


@query("q_sample_fixed", "SELECT doc_id FROM documents ORDER BY md5(concat(doc_id, '42')), doc_id LIMIT 50")
def _sample(spark, d):
    return W.sample(table(spark, d, "documents"), "doc_id", 50).select("doc_id")


@query("q_order_map", "SELECT conv_id, turn, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 WHEN 'assistant' THEN 3 ELSE 99 END AS rank FROM conversations")
def _order_map(spark, d):
    ranks = {"system": 1, "user": 2, "assistant": 3}
    return W.order_by_map(table(spark, d, "conversations"), "role", ranks, "conv_id", "turn").select("conv_id", "turn", T.lookup(F.col("role"), ranks, 99).alias("rank"))


# --- statistics ------------------------------------------------------------------------------------------------------------------------
CORE_SQL = f"SELECT count(*) AS total_rows, count(DISTINCT nullif(lower({s_norm('idiom')}), '')) AS unique_idioms, count(DISTINCT nullif(lower({s_norm('meaning')}), '')) AS unique_meanings, count(*) FILTER ({s_safe('meaning')} <> '') AS rows_with_meaning, count(*) FILTER ({s_safe('example')} <> '') AS rows_with_example, round(avg({s_count('idiom')}), 4) AS avg_idiom_tokens, min({s_count('idiom')}) AS min_idiom_tokens, max({s_count('idiom')}) AS max_idiom_tokens, round(avg(CASE WHEN {s_safe('meaning')} <> '' THEN {s_count('meaning')} END), 4) AS avg_meaning_tokens, round(avg(CASE WHEN {s_safe('example')} <> '' THEN {s_count('example')} END), 4) AS avg_example_tokens FROM idioms"


@query("q_stats_core", CORE_SQL, idioms=IDIOMS_SQL)
def _stats_core(spark, d):
    return St.core_statistics(idioms(spark, d), "idiom", "meaning", "example")


@query("q_distribution_missing", "SELECT coalesce(tags, 'MISSING') AS value, count(*) AS n FROM idioms GROUP BY 1", idioms=IDIOMS_SQL)
def _distribution(spark, d):
    return St.distribution(idioms(spark, d), "tags", "MISSING")


@query("q_shares", "SELECT pos AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM idioms WHERE pos IS NOT NULL GROUP BY 1", idioms=IDIOMS_SQL)
def _shares(spark, d):
    return St.shares(idioms(spark, d), "pos")


@query("q_filled_counts", f"SELECT 'tags' AS \"column\", count(*) AS n, count(tags) AS non_null, count(*) FILTER ({s_safe('tags')} <> '') AS non_empty, count(DISTINCT nullif({s_safe('tags')}, '')) AS unique_non_empty FROM idioms UNION ALL SELECT 'example', count(*), count(example), count(*) FILTER ({s_safe('example')} <> ''), count(DISTINCT nullif({s_safe('example')}, '')) FROM idioms", idioms=IDIOMS_SQL)
def _filled(spark, d):
    return St.filled_counts(idioms(spark, d), ["tags", "example"])


@query("q_null_audit", "SELECT c AS \"column\", n AS nulls, round(n / t, 6) AS ratio FROM (SELECT unnest(['example', 'tags', 'pos']) AS c, unnest([count(*) FILTER (example IS NULL), count(*) FILTER (tags IS NULL), count(*) FILTER (pos IS NULL)]) AS n, count(*) AS t FROM idioms) WHERE n > 0", idioms=IDIOMS_SQL)
def _null_audit(spark, d):
    return St.null_audit(idioms(spark, d))


@query("q_group_coverage", "SELECT idiom_id, count(*) AS total_rows, count(*) FILTER (row_type = 'main_example') AS main_rows, count(*) FILTER (starts_with(row_type, 'adversarial')) AS adversarial_rows FROM enriched GROUP BY 1", enriched=ENRICHED_SQL)
def _coverage(spark, d):
    return St.group_coverage(enriched(spark, d))


@query("q_coverage_ratios", "SELECT count(*) AS groups, count(*) FILTER (m < 12) AS incomplete_main, count(*) FILTER (a < 2) AS incomplete_adversarial, round(count(*) FILTER (m < 12) / count(*), 6) AS ratio_main, round(count(*) FILTER (a < 2) / count(*), 6) AS ratio_adversarial FROM (SELECT count(*) FILTER (row_type = 'main_example') AS m, count(*) FILTER (starts_with(row_type, 'adversarial')) AS a FROM enriched GROUP BY idiom_id)", enriched=ENRICHED_SQL)
def _coverage_ratios(spark, d):
    return St.coverage_ratios(St.group_coverage(enriched(spark, d)))


@query("q_top20", "SELECT p_name AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _top20(spark, d):
    return St.top_values(table(spark, d, "part"), "p_name")


@query("q_most_frequent", "SELECT text AS value, count(*) AS n FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1", lines=LINES_SQL)
def _most_frequent(spark, d):
    return St.most_frequent(lines(spark, d), "text")


@query("q_high_frequency", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 100")
def _high_frequency(spark, d):
    return St.high_frequency(table(spark, d, "events"), "event_type")


@query("q_reuse_factor", "SELECT count(text) AS n, count(DISTINCT text) AS \"unique\", round(count(text) / count(DISTINCT text), 2) AS reuse FROM documents")
def _reuse(spark, d):
    return St.reuse_factor(table(spark, d, "documents"), "text")


@query("q_sources_distinct", "SELECT source, count(DISTINCT idiom) AS n FROM idioms GROUP BY 1", idioms=IDIOMS_SQL)
def _sources_distinct(spark, d):
    return St.per_group(idioms(spark, d), "source", "idiom")


@query("q_count_summary", "SELECT count(*) AS count, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std, round(min(n), 4) AS min, round(quantile_cont(n, 0.25), 4) AS p25, round(quantile_cont(n, 0.5), 4) AS median, round(quantile_cont(n, 0.75), 4) AS p75, round(max(n), 4) AS max FROM (SELECT count(*)::DOUBLE AS n FROM orders GROUP BY o_custkey)")
def _count_summary(spark, d):
    return St.numeric_summary(St.rows_per(table(spark, d, "orders"), "o_custkey"), "n")


@query("q_stats_long", "SELECT 'core' AS section, 'rows' AS metric, count(*)::VARCHAR AS value FROM orders UNION ALL SELECT 'core', 'customers', count(DISTINCT o_custkey)::VARCHAR FROM orders")
def _stats_long(spark, d):
    return St.to_long("core", table(spark, d, "orders").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("customers")))


@query("q_proportion", "SELECT round(avg(coalesce(pos = 'phrase', false)::INT), 6) AS phrase, round(avg((source = 'wordnet')::INT), 6) AS lexical FROM idioms", idioms=IDIOMS_SQL)
def _proportion(spark, d):
    return St.proportion(idioms(spark, d), {"phrase": F.col("pos") == "phrase", "lexical": F.col("source") == "wordnet"})


@query("q_by_source", f"SELECT source, count(*) AS broad, count(*) FILTER ({STRONG_SQL}) AS high FROM idioms GROUP BY 1", idioms=IDIOMS_SQL)
def _by_source(spark, d):
    rows = idioms(spark, d)
    return St.by_source(rows, rows.where(P.strong_signal(meaning="meaning")))


@query("q_retention", "SELECT 0 AS step, 'all' AS stage, count(*) AS n, 1.0 AS retained FROM idioms UNION ALL SELECT 1, 'phrases', count(*) FILTER (pos = 'phrase'), round(count(*) FILTER (pos = 'phrase') / count(*), 6) FROM idioms", idioms=IDIOMS_SQL)
def _retention(spark, d):
    rows = idioms(spark, d)
    return St.retention({"all": rows, "phrases": rows.where("pos = 'phrase'")})


@query("q_request_estimate", "SELECT count(*) AS requests, count(*) * 300 AS tokens FROM part")
def _request_estimate(spark, d):
    return St.request_estimate(table(spark, d, "part"))


@query("q_histogram", "SELECT CASE WHEN value < 0 THEN 0 WHEN value >= 100 THEN 51 ELSE floor(value / 2)::BIGINT + 1 END AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1")
def _histogram(spark, d):
    return St.histogram(table(spark, d, "events"), "value", 0, 100)


# --- publication -----------------------------------------------------------------------------------------------------------------------
@query("q_corrupted", "SELECT doc_id, regexp_matches(text, 'idiom_in_example_|(?:meaning[_\\s]?.*?:)|(?:en\\s*:)') OR (len(text) - len(replace(text, ':', '')) >= 2 AND length(text) > 300) AS corrupted FROM documents")
def _corrupted(spark, d):
    return table(spark, d, "documents").select("doc_id", P.corrupted_example("text").alias("corrupted"))


def s_equal(c: str) -> str:
    return s_norm(f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')")


@query("q_ambiguous_examples", f"SELECT _pos FROM (SELECT *, {s_equal('text')} AS e FROM rows) WHERE e <> {s_equal('source')} AND e NOT IN (SELECT e FROM (SELECT {s_equal('text')} AS e, source FROM rows WHERE {s_equal('text')} <> {s_equal('source')}) GROUP BY e HAVING count(DISTINCT source) > 1)", rows="SELECT doc_id AS _pos, text, source FROM documents")
def _ambiguous(spark, d):
    rows = table(spark, d, "documents").withColumnRenamed("doc_id", "_pos")
    return Pub.clean_merged(rows, "text", "source").select("_pos")


@query("q_variant_flags", f"SELECT doc_id, n AS n_idioms_per_example FROM documents JOIN (SELECT {s_equal('text')} AS e, count(DISTINCT source) AS n FROM documents GROUP BY 1) ON {s_equal('text')} = e")
def _variants(spark, d):
    return Pub.variant_flags(table(spark, d, "documents"), "text", "source").select("doc_id", "n_idioms_per_example")


@query("q_label_repair", "SELECT _pos, coalesce(label, CASE flag WHEN true THEN 'idiomatic' WHEN false THEN 'literal' END, 'idiomatic') AS label, coalesce(flag, label = 'idiomatic', true) AS flag FROM meta", meta=META_SQL)
def _label_repair(spark, d):
    return Pub.repair_labels(metadata(spark, d), label="label", flag="flag").select("_pos", "label", "flag")


@query("q_quality_tiers", "SELECT a.vec_id, s AS similarity, CASE WHEN s >= 0.35 THEN 'high' WHEN s >= 0.15 THEN 'medium' ELSE 'low' END AS v1, CASE WHEN s >= 0.4 THEN 'high' WHEN s >= 0.2 THEN 'medium' ELSE 'low' END AS v2, CASE WHEN s >= 0.35 THEN 'high' WHEN s >= 0.18 THEN 'medium' ELSE 'low' END AS v3 FROM (SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) a")
def _tiers(spark, d):
    a = table(spark, d, "embeddings")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    rows = a.join(b, "vec_id").select("vec_id", F.round(Sim.cosine("embedding", "other"), 6).alias("similarity"))
    return rows.select("vec_id", "similarity", S.tier("similarity", 0.35, 0.15).alias("v1"), S.tier("similarity", 0.4, 0.2).alias("v2"), S.tier("similarity", 0.35, 0.18).alias("v3"))


@query("q_low_quantile", "SELECT p_partkey FROM part WHERE p_retailprice < (SELECT quantile_cont(p_retailprice, 0.05) FROM part)")
def _low_quantile(spark, d):
    return Pub.below_quantile(table(spark, d, "part"), "p_retailprice").select("p_partkey")


_TERMS = f"list_filter(regexp_extract_all(lower({{0}}), '[\\p{{{{L}}}}\\p{{{{N}}}}_]+'), lambda t: length(t) >= 2 AND NOT list_contains({s_arr(Sim.SHORT_STOPWORDS)}, t))"


@query("q_tfidf_pair", "SELECT item_id, CASE WHEN len(x) + len(y) = 0 THEN NULL WHEN nx * ny = 0 THEN 0 ELSE round(coalesce(list_sum(list_transform(list_intersect(list_distinct(x), list_distinct(y)), lambda t: len(list_filter(x, lambda u: u = t)) * len(list_filter(y, lambda u: u = t)))), 0) / (sqrt(nx) * sqrt(ny)), 4) END AS similarity FROM (SELECT *, coalesce(list_sum(list_transform(list_distinct(x), lambda t: power(len(list_filter(x, lambda u: u = t)) * CASE WHEN list_contains(y, t) THEN 1 ELSE 1 + ln(1.5) END, 2))), 0) AS nx, coalesce(list_sum(list_transform(list_distinct(y), lambda t: power(len(list_filter(y, lambda u: u = t)) * CASE WHEN list_contains(x, t) THEN 1 ELSE 1 + ln(1.5) END, 2))), 0) AS ny FROM terms)",
       words="SELECT a.item_id, " + _TERMS.format("a.text").replace("{{", "{").replace("}}", "}") + " AS p, " + _TERMS.format("b.text").replace("{{", "{").replace("}}", "}") + " AS q FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1",
       terms="SELECT item_id, list_concat(p, list_transform(range(1, len(p)), lambda i: concat(p[i], ' ', p[i + 1]))) AS x, list_concat(q, list_transform(range(1, len(q)), lambda i: concat(q[i], ' ', q[i + 1]))) AS y FROM words")
def _tfidf(spark, d):
    a = table(spark, d, "benchmark")
    b = a.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other"))
    return a.join(b, "item_id").select("item_id", Sim.tfidf_pair("text", "other").alias("similarity"))


@query("q_task_subset", "SELECT _pos, label FROM meta WHERE (src = 'src1' OR flag) AND label IS DISTINCT FROM 'literal'", meta=META_SQL)
def _task_subset(spark, d):
    rows = metadata(spark, d).withColumns({"semantic_quality": F.when(F.col("src") == "src1", "high"), "validation_status": F.when(F.col("flag"), "verified"), "example_usage_label": F.when(F.col("label") == "literal", "borderline").otherwise(F.col("label"))})
    return rows.where(P.task_row()).select("_pos", "label")


@query("q_removed_rows", "SELECT _pos FROM meta WHERE NOT ((src = 'src1' OR coalesce(flag, false)) AND label IS DISTINCT FROM 'literal')", meta=META_SQL)
def _removed(spark, d):
    rows = metadata(spark, d)
    return J.not_in(rows, _task_subset(spark, d).select("_pos"), "_pos").select("_pos")


@query("q_pre_enrichment", f"SELECT concat('idiom_', substr(md5(concat(lower({s_norm('idiom')}), ' || ', lower({s_norm('meaning')}))), 1, 12)) AS idiom_id, {s_norm('idiom')} AS idiom_canonical, nullif({s_norm('meaning')}, '') AS idiom_canonical_meaning, {s_case('source', Pub.LICENSES, chr(39) + 'unknown' + chr(39))} AS license_source, nullif(tags, '') AS tags FROM idioms", idioms=IDIOMS_SQL)
def _pre_enrichment(spark, d):
    rows = Sch.ensure_columns(sourced(spark, d), Sch.SOURCE_COLUMNS)
    return Pub.pre_enrichment(rows).select("idiom_id", "idiom_canonical", "idiom_canonical_meaning", "license_source", "tags")


@query("q_fill_pair_ids", "SELECT _pos, CASE WHEN row_type = 'main_example' THEN coalesce(minimal_pair_id, concat('mp_', replace(lower(idiom_canonical), ' ', '_'), '__', context_type, '__', example_usage_label, '__', row_number() OVER (PARTITION BY idiom_canonical, context_type, example_usage_label, row_type = 'main_example' ORDER BY _pos) - 1)) ELSE minimal_pair_id END AS minimal_pair_id FROM enriched", enriched=ENRICHED_SQL)
def _fill_pair_ids(spark, d):
    return Pub.fill_pair_ids(enriched(spark, d)).select("_pos", "minimal_pair_id")


# --- enrichment, validation --------------------------------------------------------------------------------------------------------------
@query("q_row_validate", "SELECT _pos, CASE WHEN idiom_id = '' THEN 'missing_idiom_id' WHEN row_type = 'other' THEN 'invalid_row_type' WHEN source_style = 'odd' THEN 'invalid_source_style' WHEN trim(idiom_in_example) = '' THEN 'missing_example_en' WHEN idiom_in_example_arabic IS NULL THEN 'missing_example_arabic' WHEN idiom_level_explanation_en = '' THEN 'missing_idiom_level_explanation_en' WHEN hard_negative_idioms = '[\"a\",\"b\"]' THEN 'missing_or_short_hard_negative_idioms' WHEN " + s_count("idiom_in_example") + " < 2 THEN 'example_too_short' WHEN row_type = 'main_example' THEN CASE WHEN example_usage_label NOT IN ('idiomatic', 'literal') THEN 'invalid_main_example_usage_label' WHEN context_type = 'adversarial' THEN 'main_example_cannot_have_adversarial_context' WHEN len(list_filter(list_distinct(regexp_extract_all(lower(idiom_surface), '[\\p{L}\\p{N}_]+')), lambda t: NOT list_contains(regexp_extract_all(lower(idiom_in_example), '[\\p{L}\\p{N}_]+'), t))) > 1 THEN 'surface_not_in_example' WHEN is_example_idiom IS NULL THEN 'missing_is_example_idiom' WHEN example_usage_label = 'idiomatic' AND lower(is_example_idiom) NOT IN ('true', '1') THEN 'label_boolean_mismatch_idiomatic' WHEN example_usage_label = 'literal' AND lower(is_example_idiom) NOT IN ('false', '0') THEN 'label_boolean_mismatch_literal' WHEN minimal_pair_id IS NULL THEN 'missing_minimal_pair_id' END ELSE CASE WHEN adversarial_type = 'odd' THEN 'invalid_adversarial_type' WHEN expected_label = 'odd' THEN 'invalid_expected_label' END END AS problem FROM enriched", enriched=ENRICHED_SQL)
def _row_validate(spark, d):
    return V.validate_rows(enriched(spark, d)).select("_pos", "problem")


_CHECKS = "SELECT idiom_id, 'unexpected_main_example_count_per_idiom' AS problem, '' AS context_type, concat('main_count=', m) AS idiom_in_example FROM g WHERE m <> 12 UNION ALL SELECT idiom_id, 'unexpected_adversarial_example_count_per_idiom', '', concat('adv_count=', a) FROM g WHERE a <> 2 UNION ALL SELECT idiom_id, 'unexpected_idiomatic_main_count_per_idiom', '', concat('idiomatic_count=', i) FROM g WHERE m > 0 AND i <> 6 UNION ALL SELECT idiom_id, 'unexpected_literal_main_count_per_idiom', '', concat('literal_count=', l) FROM g WHERE m > 0 AND l <> 6 UNION ALL SELECT idiom_id, 'unexpected_context_pair_count_per_idiom', c, concat('context_count=', coalesce(n, 0)) FROM (SELECT g.idiom_id, c, (SELECT count(*) FROM enriched e WHERE e.idiom_id = g.idiom_id AND row_type = 'main_example' AND e.context_type = c) AS n FROM g, (SELECT unnest(" + s_arr(L.CONTEXTS) + ") AS c) WHERE m > 0) WHERE n <> 2"


@query("q_group_validate", _CHECKS, enriched=ENRICHED_SQL, g="SELECT idiom_id, count(*) FILTER (row_type = 'main_example') AS m, count(*) FILTER (starts_with(row_type, 'adversarial_example')) AS a, count(*) FILTER (row_type = 'main_example' AND example_usage_label = 'idiomatic') AS i, count(*) FILTER (row_type = 'main_example' AND example_usage_label = 'literal') AS l FROM enriched GROUP BY 1")
def _group_validate(spark, d):
    return V.group_issues(enriched(spark, d)).select("idiom_id", "problem", "context_type", "idiom_in_example")


_ISSUES = f"""SELECT v._pos AS row_index, problem, idiom_id, idiom_canonical, row_type, context_type, example_usage_label, expected_label, idiom_surface, idiom_in_example FROM ({ORACLES['q_row_validate']}) v JOIN ({ENRICHED_SQL}) e ON v._pos = e._pos WHERE problem IS NOT NULL
UNION ALL SELECT NULL, problem, c.idiom_id, n.idiom_canonical, 'group_check', context_type, '', '', '', idiom_in_example FROM ({ORACLES['q_group_validate']}) c JOIN (SELECT idiom_id, min(idiom_canonical) AS idiom_canonical FROM ({ENRICHED_SQL}) GROUP BY 1) n ON c.idiom_id = n.idiom_id"""


@query("q_issue_union", _ISSUES)
def _issues(spark, d):
    return V.issues(V.validate_rows(enriched(spark, d)), "_pos")


def _results(spark, d) -> DataFrame:
    """Result lines made of events: nested records as a model would answer, some broken, some without an answer."""
    e = R.dealt(table(spark, d, "events"), 100_000)
    record = F.struct((F.col("event_id") % 5 != 0).alias("is_idiom"), F.lit("valid_idiom").alias("idiom_validity_label"), F.concat(F.lit("idiom "), "event_type").alias("idiom_canonical"), F.array(F.lit("x"), F.lit("y")).alias("hard_negative_idioms"),
        F.transform(F.sequence(F.lit(1), (F.col("event_id") % 3 + 1).cast("int")), lambda i: F.struct(F.concat(F.lit("c"), i.cast("string")).alias("context_type"), F.concat("event_type", F.lit(" "), i.cast("string")).alias("idiom_in_example"), F.lit("literal").alias("example_usage_label"), F.lit(False).alias("is_example_idiom"))).alias("examples"),
        F.array(F.struct(F.lit("adv").alias("idiom_in_example"), F.lit("idiomatic").alias("expected_label"), F.lit("negation").alias("adversarial_type"))).alias("adversarial_examples"))
    text = F.when(F.col("event_id") % 7 == 0, F.lit("no json")).when(F.col("event_id") % 7 == 1, F.concat(F.lit("Sure: "), F.to_json(record), F.lit(" done"))).otherwise(F.to_json(record))
    item = F.struct(F.lit("message").alias("type"), F.array(F.struct(F.lit("output_text").alias("type"), text.alias("text"))).alias("content"))
    body = F.struct(F.lit("m").alias("model"), F.array(item).alias("output"))
    return e.select(F.to_json(F.struct(F.concat(F.lit("id_"), F.col("event_id").cast("string")).alias("custom_id"), F.struct(body.alias("body")).alias("response"))).alias("value"))


@query("q_result_flatten", "SELECT concat('id_', event_id) AS idiom_id, 'main_example' AS row_type, concat('c', i) AS context_type, concat(event_type, ' ', i) AS idiom_in_example, 'literal' AS expected_label, concat('pair_', substr(md5(concat('id_', event_id, '||c', i)), 1, 12)) AS minimal_pair_id FROM (SELECT event_id, event_type, unnest(range(1, event_id % 3 + 2)) AS i FROM events WHERE event_id % 7 <> 0) UNION ALL SELECT concat('id_', event_id), 'adversarial_example_1', 'adversarial', 'adv', 'idiomatic', NULL FROM events WHERE event_id % 7 <> 0")
def _flatten(spark, d):
    return E.flatten_core(E.parse_results(_results(spark, d))).select("idiom_id", "row_type", "context_type", "idiom_in_example", "expected_label", "minimal_pair_id")


@query("q_result_flatten_extended", "SELECT idiom_id, 'idiom_only' AS row_type, 0 AS k, '' AS context_type, '' AS idiom_in_example, '' AS example_usage_label, '' AS expected_label, '' AS idiom_surface FROM e WHERE NOT ok UNION ALL SELECT idiom_id, 'main_example', i - 1, concat('c', i), concat(event_type, ' ', i), 'literal', '', '' FROM (SELECT *, unnest(range(1, event_id % 3 + 2)) AS i FROM e WHERE ok) UNION ALL SELECT idiom_id, 'adversarial_example', 0, 'adversarial', 'adv', '', 'idiomatic', concat('idiom ', event_type) FROM e WHERE ok", e="SELECT event_id, event_type, concat('id_', event_id) AS idiom_id, event_id % 5 <> 0 AS ok FROM events WHERE event_id % 7 <> 0")
def _flatten_extended(spark, d):
    return E.flatten_extended(E.parse_results(_results(spark, d))).select("idiom_id", "row_type", F.col("at").alias("k"), "context_type", "idiom_in_example", "example_usage_label", "expected_label", "idiom_surface")


@query("q_result_parse_fail", "SELECT count(*) FILTER (event_id % 7 <> 0) AS parsed, count(*) FILTER (event_id % 7 = 0) AS failed FROM events")
def _parse_fail(spark, d):
    return E.parse_counts(E.parse_results(_results(spark, d)))


@query("q_enriched_pipeline", "SELECT idiom_id, 'main_example' AS row_type, concat('c', i) AS context_type, concat(event_type, ' ', i) AS idiom_in_example, 'literal' AS example_usage_label, 'literal' AS expected_label, false AS is_example_idiom, NULL::VARCHAR AS minimal_pair_id, false AS is_adversarial_example, idiom_id AS paraphrase_group_id FROM (SELECT *, unnest(range(1, event_id % 3 + 2)) AS i FROM e) UNION ALL SELECT idiom_id, 'adversarial_example_1', 'adversarial', 'adv', 'borderline', 'idiomatic', NULL, NULL, true, idiom_id FROM e", e="SELECT event_id, event_type, concat('id_', event_id) AS idiom_id FROM events WHERE event_id % 7 <> 0 AND event_id % 5 <> 0")
def _enriched_pipeline(spark, d):
    return Plan.enriched(E.parse_results(_results(spark, d))).select("idiom_id", "row_type", "context_type", "idiom_in_example", "example_usage_label", "expected_label", "is_example_idiom", "minimal_pair_id", "is_adversarial_example", "paraphrase_group_id")


@query("q_request_json", "SELECT concat('req_', p_partkey) AS custom_id, 'POST' AS method, concat('Explain ', p_name, '!') AS prompt FROM part")
def _request_json(spark, d):
    prompt = E.fill_template("Explain {name}!", {"name": F.col("p_name")})
    rows = E.build_requests(table(spark, d, "part"), F.concat(F.lit("req_"), F.col("p_partkey").cast("string")), prompt, "m", E.json_schema({"a": "string", "b": ["x", "y"], "c": ({"d": "boolean"}, 2)}))
    v = F.parse_json("value")
    return rows.select(*[F.try_variant_get(v, p, "string").alias(n) for n, p in (("custom_id", "$.custom_id"), ("method", "$.method"), ("prompt", "$.body.input"))])


@query("q_repair_log", "SELECT _pos, 'needs_review' AS status_before, CASE WHEN _pos % 3 = 0 THEN 'corrected' WHEN _pos % 3 = 1 THEN 'verified' ELSE 'invalid' END AS status_after, CASE WHEN _pos % 3 = 0 AND row_type = 'main_example' AND example_usage_label <> 'borderline' THEN example_usage_label WHEN _pos % 3 = 0 AND row_type = 'main_example' THEN 'borderline' WHEN _pos % 3 = 0 THEN 'borderline' ELSE example_usage_label END AS label FROM enriched WHERE _pos % 2 = 0", enriched=ENRICHED_SQL)
def _repair_log(spark, d):
    rows = enriched(spark, d).withColumn("validation_status", F.lit("needs_review"))
    new = F.struct(*[(F.lit("borderline") if c in ("example_usage_label", "expected_label") else F.lit("new")).alias(c) for c in E.CORRECTED])
    k = F.col("_pos") % 3
    verdicts = rows.where("_pos % 2 = 0").select("_pos", (k == 1).alias("is_valid"), (k == 0).alias("correction_needed"), new.alias("corrected"), F.lit(None).cast("string").alias("error"))
    done = E.apply_verdicts(rows, verdicts, "_pos")
    return E.verdict_log(rows, done, "_pos", ["example_usage_label"]).select("_pos", "status_before", "status_after", F.col("example_usage_label_after").alias("label"))


@query("q_unprocessed", "SELECT _pos FROM enriched WHERE _pos % 2 <> 0", enriched=ENRICHED_SQL)
def _unprocessed(spark, d):
    rows = enriched(spark, d)
    return E.unprocessed(rows, rows.where("_pos % 2 = 0"), "_pos").select("_pos")


# --- sources -----------------------------------------------------------------------------------------------------------------------------
@query("q_html_links", "SELECT page_id, unnest(range(len(urls))) AS at, unnest(urls) AS url FROM (SELECT page_id, regexp_extract_all(html, '(?i)href\\s*=\\s*[\"'']([^\"'']+)[\"'']', 1) AS urls FROM pages)")
def _links(spark, d):
    return Pages.all_links(table(spark, d, "pages"))


HIDDEN = "(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<head\\b.*?</head\\s*>|<!--.*?-->"
BLOCKS = "(?i)<br\\s*/?>|</(?:p|div|li|h[1-6]|tr|section|article|ul|ol|title)\\s*>"
VISIBLE = f"regexp_replace(regexp_replace(regexp_replace(html, '{HIDDEN}', ' ', 'g'), '{BLOCKS}', chr(10), 'g'), '(?s)<[^>]*>', '', 'g')"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    VISIBLE = f"replace({VISIBLE}, '{_entity}', '{_char}')"


@query("q_html_text", f"SELECT page_id, md5({s_norm(VISIBLE)}) AS text FROM pages")
def _html_text(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.norm(Pages.visible_text("html")).cast("binary")).alias("text"))


@query("q_nested_senses", "SELECT p_partkey AS _pos, i AS sense_index, CASE i WHEN 0 THEN concat('sense of ', p_type) ELSE concat('raw ', p_brand) END AS meaning, CASE i WHEN 0 THEN concat('ex ', p_name) ELSE '' END AS example FROM part, (SELECT unnest([0, 2]) AS i) WHERE p_partkey % 4 <> 0")
def _senses(spark, d):
    p = table(spark, d, "part")
    sense = lambda **k: F.struct(*[k.get(c, F.array().cast("array<string>")).alias(c) for c in ("tags", "topics", "glosses", "raw_glosses")], k.get("examples", F.array().cast("array<string>")).alias("examples"))
    senses = F.array(sense(glosses=F.array(F.lit(""), F.concat(F.lit(" sense  of "), "p_type")), examples=F.array(F.lit(""), F.concat(F.lit("ex "), "p_name"))), sense(glosses=F.array(F.concat(F.lit("plural of "), "p_name"))), sense(raw_glosses=F.array(F.concat(F.lit("raw "), "p_brand"))))
    entry = F.struct(F.col("p_name").alias("word"), F.when(F.col("p_partkey") % 4 == 0, "French").otherwise("English").alias("lang"), F.lit("phrase").alias("pos"), F.lit("u").alias("wiktionary_url"), senses.alias("senses"))
    parsed = R.parse_json_lines(p.select(F.col("p_partkey").alias("_pos"), F.to_json(entry).alias("value")))
    return R.dictionary_senses(parsed).select("_pos", "sense_index", "meaning", "example")


@query("q_json_line_counts", "SELECT count(*) AS lines, count(*) FILTER (event_id % 9 <> 0) AS parsed FROM events")
def _line_counts(spark, d):
    e = table(spark, d, "events")
    value = F.when(F.col("event_id") % 9 == 0, F.lit("{broken")).otherwise(F.col("props"))
    return R.line_counts(R.parse_json_lines(e.select(value.alias("value")), "k long"))


@query("q_lexical_entries", "SELECT lower(p_name) AS idiom, p_type AS meaning_en, p_brand AS pos FROM part WHERE contains(p_name, ' ')")
def _lexical(spark, d):
    p = table(spark, d, "part").select(F.col("p_type").alias("definition"), F.col("p_brand").alias("pos"), F.array(F.translate("p_name", " ", "_"), F.lit("single")).alias("lemmas"))
    return R.lexical_entries(p)


@query("q_inventory", f"SELECT DISTINCT {s_key('p_name')} AS idiom_canonical FROM part")
def _inventory(spark, d):
    return R.inventory(table(spark, d, "part").select(F.col("p_name").alias("idiom_canonical")))


@query("q_generated_inventory", f"SELECT idiom_canonical, arg_min(custom_id, custom_id) AS custom_id, arg_min(meaning, custom_id) AS proposed_meaning_en FROM (SELECT {s_key('p_name')} AS idiom_canonical, concat('g_', p_partkey) AS custom_id, p_type AS meaning FROM part WHERE {s_count('p_name')} BETWEEN 2 AND 6 AND NOT {s_prefix('lower(p_name)', ('go to', 'make a', 'have a', 'do a', 'get a', 'take a', 'go for', 'come to'))}) WHERE idiom_canonical NOT IN (SELECT {s_key('p_name')} FROM part WHERE p_size < 3) GROUP BY 1")
def _generated(spark, d):
    p = table(spark, d, "part")
    record = F.struct(F.lit("g").alias("generation_category"), F.array(F.struct(F.col("p_name").alias("idiom_candidate"), F.col("p_type").alias("proposed_meaning_en"))).alias("candidates"))
    body = F.struct(F.array(F.struct(F.array(F.struct(F.to_json(record).alias("text"))).alias("content"))).alias("output"))
    results = p.select(F.to_json(F.struct(F.concat(F.lit("g_"), F.col("p_partkey").cast("string")).alias("custom_id"), F.struct(body.alias("body")).alias("response"))).alias("value"))
    return Plan.generated_inventory(results, p.where("p_size < 3").select(F.col("p_name").alias("idiom_canonical"))).select("idiom_canonical", "custom_id", "proposed_meaning_en")


@query("q_cascade", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_retailprice > 1500 THEN 'dear' ELSE 'plain' END AS kind FROM part")
def _cascade(spark, d):
    return table(spark, d, "part").select("p_partkey", cascade([(F.col("p_size") < 10, "small"), (F.col("p_retailprice") > 1500, "dear")], "plain").alias("kind"))


from phraseloom import queries_io  # noqa: E402, F401  (registers its own)
