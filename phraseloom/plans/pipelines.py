"""The pipelines as compositions of operators. Each takes and returns DataFrames; where a stage is published, the caller writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import predicates as P
from phraseloom.functions import scores as S
from phraseloom.functions import similarity as Sim
from phraseloom.functions import text as T
from phraseloom.operators import dedup as D
from phraseloom.operators import enrich as E
from phraseloom.operators import joins as J
from phraseloom.operators import mining as M
from phraseloom.operators import publish as Pub
from phraseloom.operators import schema as Sch
from phraseloom.operators import windows as W
from phraseloom.operators.validate import issues, validate_rows
from phraseloom.sources import readers as R
from phraseloom.sources.scratch import scratch_folder


def strict_filter(senses: DataFrame) -> DataFrame:
    rows = senses.where(P.strict_phrase() & P.pos_allowed() & P.meaning_allowed(L.STRICT_BAD_MEANINGS, "meaning") & P.idiom_signal())
    return D.first_row(rows, [F.lower(T.safe("idiom")), F.lower(T.safe("meaning"))])


def clean(rows: DataFrame) -> DataFrame:
    return D.best_two_level(rows.where(P.clean_row()), [F.lower("idiom"), F.lower("meaning")], ["idiom"], S.clean_score())


def high_precision(rows: DataFrame) -> DataFrame:
    return D.best_scored(rows.where(P.high_precision()), ["idiom"], S.precision_score())


def core_inventory(entries: DataFrame, lexical: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Dictionary entries and lexical-database rows, both with ``_pos``, their place in the input -> broad and high-precision sets.

    Sets are in the source schema; their ``_pos`` is (branch, place, sense), so that the first wins in the order of the input.
    """
    senses = R.dictionary_senses(entries).withColumn("_pos", F.struct(F.lit(0).alias("branch"), F.col("_pos").cast("long").alias("place"), F.col("sense_index").cast("int").alias("sense")))
    return core_of_senses(senses, lexical)


def core_of_senses(senses: DataFrame, lexical: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The same from sense rows whose ``_pos`` is (branch, place, sense). What the stages keep is written once and read by both sets."""
    senses = D.first_row(senses, [F.lower("idiom"), F.lower("meaning")])
    rows = high_precision(clean(strict_filter(senses)))
    merged = Sch.to_source_schema(rows, "kaikki_wiktionary", "dictionary", "high", keep=("_pos",))
    if lexical is not None:
        other = Sch.normalize_source(lexical.withColumns({"source": F.lit("wordnet"), "source_type": F.lit("lexical_database"), "idiom_confidence": F.lit("medium"), "_pos": F.struct(F.lit(1).alias("branch"), F.col("_pos").cast("long").alias("place"), F.lit(0).alias("sense"))}))
        merged = Sch.align_union(merged, other.select(*Sch.SOURCE_COLUMNS, "_pos"))
    merged = D.first_row(merged, [F.lower(T.safe("idiom")), F.lower(T.safe("meaning_en"))])
    return global_filter(_written(merged, "core-merged"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_filter(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    base = Sch.normalize_source(rows).where(P.global_basics())
    keys = [T.lower_norm("idiom"), T.lower_norm("meaning_en")]
    broad = D.first_row(base.where(P.broad_signal()), keys)
    return broad, D.best_scored(base.where(P.strong_signal()), keys, S.global_score())


def crowd_slang(rows: DataFrame) -> DataFrame:
    kept = Sch.normalize_source(rows).where(P.crowd_row())
    return D.best_scored(kept, [T.idiom_key("idiom")], S.crowd_score(), "meaning_en", "example")


def dictionary_slang(rows: DataFrame) -> DataFrame:
    kept = Sch.normalize_source(rows).where(P.good_phrase() & P.meaning_allowed(L.SLANG_CLEAN_BAD_MEANINGS, "meaning_en", empty=False) & ~P.explicit("idiom", "meaning_en", "example") & ~P.weak_generic() & ~P.too_literal())
    kept = D.first_row(kept, [T.idiom_key("idiom"), T.idiom_key("meaning_en"), T.norm("example")])
    return D.best_scored(kept, [T.idiom_key("idiom")], S.slang_clean_score(), "meaning_en", "example")


def merge_stage_1(*sources: DataFrame) -> DataFrame:
    rows = sources[0]
    for s in sources[1:]:
        rows = Sch.align_union(rows, s)
    return D.best_scored(rows, [T.idiom_key("idiom"), T.idiom_key("meaning_en")], S.merge_score_1())


def merge_stage_2(merged: DataFrame, dialogue: DataFrame) -> DataFrame:
    rows = Sch.align_union(merged, dialogue)
    return D.best_scored(rows, [T.idiom_key("idiom"), T.idiom_key("meaning_en")], S.merge_score_2())


def dialogue_candidates(lines: DataFrame, min_count: int = 5, line_id: str = "line_id", text: str = "text") -> DataFrame:
    """Mined and cleaned phrases in the source schema."""
    mined = M.mine_phrases(lines, min_count, line_id, text)
    rows = mined.select(F.col("phrase").alias("idiom"), F.lit("").alias("meaning_en"), "example", F.lit(L.DIALOGUE_SOURCE).alias("source"), F.lit("dialogue").alias("source_type"), F.lit("phrase").alias("pos"), F.lit("candidate,dialogue,repeated_ngram").alias("tags"), F.lit("low").alias("idiom_confidence"), F.lit("").alias("source_url"), F.col("phrase").alias("_pos"))
    return M.clean_candidates(rows)


def modern_filter(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged modern sources -> broad and high-quality sets; the second is filtered from the first, which is written once."""
    base = Sch.normalize_source(rows, {"idiom": T.idiom_key})
    pick = lambda df: D.unique_pairs_plus_best(df, T.idiom_key("idiom"), T.idiom_key("meaning_en"), S.best_row_score())
    broad = _written(pick(base.where(P.broad_keep())), "modern-broad")
    return broad, pick(broad.where(P.high_quality_keep()))


def modern_inventory(broad: DataFrame, high: DataFrame, main: DataFrame, with_ratio: bool = True) -> DataFrame:
    """High rows and the rest of broad, new against the main inventory (columns idiom, meaning, example, _pos), one row per idiom."""
    rows = J.rest_of_broad(high, broad, ["idiom", "meaning_en"])
    matched = J.match_status(rows.withColumnRenamed("meaning_en", "meaning"), main, with_ratio=with_ratio)
    kept = matched.where(F.startswith("status", F.lit("keep_"))).withColumnRenamed("meaning", "meaning_en")
    score = S.before_enrichment_score("meaning_en")
    return D.best_scored(kept, [T.idiom_key("idiom")], score).select(*rows.columns)


def generated_inventory(results: DataFrame, known: DataFrame) -> DataFrame:
    """Generated candidates, valid, not known yet, one per idiom; ``known`` has idiom_canonical."""
    found = E.candidates_of(results).where(P.generated_candidate())
    rows = found.withColumns({"idiom_canonical": T.idiom_key("idiom_candidate"), "_pos": F.struct("custom_id", "at")})
    rows = J.not_in(rows, R.inventory(known), "idiom_canonical")
    return D.first_row(rows, ["idiom_canonical"])


def enriched(parsed: DataFrame, position: str = "_pos") -> DataFrame:
    """Parsed result records -> merge-ready rows of the extended branches. Rows are written once, as each step of ``finalize`` reads them."""
    rows = E.flatten_extended(parsed).where(P.valid_idiom())
    rows = _written(rows.withColumn(position, F.struct("idiom_id", "row_type", "at")), "enriched-rows")
    return Pub.finalize(rows, position)


def validated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    done = validate_rows(rows)
    return done, issues(done, "_pos")


def publication(rows: DataFrame, train: int = 80) -> DataFrame:
    """Enriched rows -> cleaned examples with repaired labels, filled metadata, quality and a leakage-safe split."""
    out = Pub.clean_merged(Pub.clean_examples(rows))
    out = Pub.fill_metadata(Pub.repair_labels(out))
    out = W.fill_both_ways(out, "idiom_canonical", "idiom_canonical_meaning")
    out = Pub.add_quality(out, Sim.tfidf_pair("example", "idiom_in_example_meaning_en"))
    return W.split_by_key(out, "example_normalized", train)
