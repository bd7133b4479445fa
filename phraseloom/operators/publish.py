"""Publication: finalisation for the merge, example filters, label and metadata fills, merges and task subsets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import predicates as P
from phraseloom.functions import scores as S
from phraseloom.functions import text as T
from phraseloom.operators import dedup as D
from phraseloom.operators import windows as W

ROW_ORDER = {"main_example": 1, "adversarial_example_1": 2, "adversarial_example_2": 3}

# Licences, names, defaults.
LICENSES = {"kaikki_wiktionary": "wiktionary_cc_by_sa_4_0", "wordnet": "wordnet", "wiktionary_slang_kaikki": "wiktionary_cc_by_sa_4_0", "urban_dictionary": "unknown", "opensubtitles_dialogue": "opensubtitles"}
SOURCE_NAMES = {"kaikki": "kaikki_wiktionary", "wiktionary": "kaikki_wiktionary", "kaikki.org": "kaikki_wiktionary", "word_net": "wordnet", "WordNet": "wordnet"}
PROVENANCE_CONFIDENCE = {"modern_pipeline": "high", "llm_enriched_v2": "medium", "synthetic_llm_enriched": "synthetic"}
MODERN_DEFAULTS = {"source": "modern_combined", "source_type": "slang_collection", "source_url": "unknown", "pos": "phrase", "tags": "idiomatic_expression", "idiom_confidence": "1.0", "record_origin": "modern_pipeline", "license_source": "mixed_sources", "enrichment_version": "modern_v1"}


def license_of(source: Column | str) -> Column:
    """(SC21, SC64)"""
    return T.lookup(T.lower_norm(source), LICENSES, "unknown")


def source_name(source: Column | str) -> Column:
    """Aliases resolved, other names unchanged (SC21)."""
    s = T.norm(source)
    return F.coalesce(T.lookup(s, SOURCE_NAMES), s)


def pre_enrichment(df: DataFrame, prefix: str = "idiom_", origin: str = "source") -> DataFrame:
    """Source rows in the pre-enrichment schema: stable ids, canonical names, licences, blanks as null (PRJ4, PRJ5, PRJ14)."""
    from phraseloom.operators.schema import PRE_ENRICHMENT_COLUMNS, blanks_to_null

    rows = df.withColumns({"idiom": T.norm("idiom"), "meaning_en": T.norm("meaning_en"), "source": source_name("source")})
    out = rows.select(T.short_id(prefix, "idiom", "meaning_en").alias("idiom_id"), F.col("idiom").alias("idiom_canonical"), F.col("idiom").alias("idiom_surface"), "example", F.col("meaning_en").alias("idiom_canonical_meaning"), "source", "source_type", "pos", "tags", "idiom_confidence", "source_url", F.lit(origin).alias("record_origin"), license_of("source").alias("license_source"), F.lit("en").alias("example_language"), F.lit("en").alias("meaning_language"))
    return blanks_to_null(out).select(*PRE_ENRICHMENT_COLUMNS)


def valid_only(df: DataFrame) -> DataFrame:
    """Valid rows, null texts as '' (UD22)."""
    return df.where(P.valid_idiom()).fillna("")


def prepare_rows(df: DataFrame) -> DataFrame:
    """Clean texts and flags of flattened rows; null texts become ''."""
    texts = ("idiom_id", "idiom_canonical", "row_type", "context_type", "example_usage_label", "expected_label", "source_style", "idiom_surface", "idiom_in_example", "adversarial_type")
    from phraseloom.operators.schema import ensure_columns

    out = ensure_columns(df, (*texts, "is_example_idiom"))
    return out.withColumns({c: T.safe(c) for c in texts} | {"is_example_idiom": T.nullable_bool("is_example_idiom")})


def finalize(df: DataFrame, position: str = "_pos", version: str = "v2") -> DataFrame:
    """Merge-ready rows of the enriched branches (UD13, UD23-UD25).

    ``v1``: two adversarial rows by (type, example), every context paired, an adversarial row without expected label takes its usage
    label. ``generated``: as v1, but adversarial rows by example alone. ``v2``: one idiomatic and one literal row per context (the best
    by example and surface), two adversarial rows by (has example, length, type), other rows gone, adversarial labels outside
    the set become borderline, main flags follow labels, and only complete contexts get a pair id. Order: see merge_order.
    """
    rows = prepare_rows(df)
    main, adversarial = F.col("row_type") == "main_example", F.contains(F.lower("row_type"), F.lit("adversarial"))
    label = F.col("example_usage_label")
    keys = ["idiom_id", "context_type"]
    both = (F.count_if(label == "idiomatic") > 0) & (F.count_if(label == "literal") > 0)
    if version == "v2":
        kept = D.best_example_row(rows.where(main & label.isin(*L.MAIN_LABELS)), [*keys, "example_usage_label"], position=position)
        e = F.col("idiom_in_example")
        order = [F.desc((e != "").cast("int")), F.desc(F.length(e)), "adversarial_type", position]
        adv = W.split_adversarial(rows.where(adversarial & ~main), order)
        valid = lambda c: F.when(F.col(c).isin(*L.LABELS), F.col(c)).otherwise("borderline")
        adv = adv.withColumns({"expected_label": valid("expected_label"), "example_usage_label": valid("example_usage_label")})
        kept = kept.withColumns({"expected_label": label, "is_example_idiom": label == "idiomatic"})
        kept = W.pair_ids(kept, keys, both)
    else:
        order = ["idiom_in_example", position] if version == "generated" else ["adversarial_type", "idiom_in_example", position]
        adv = W.split_adversarial(rows.where(adversarial & ~main), order)
        adv = adv.withColumn("expected_label", F.when(F.col("expected_label") == "", label).otherwise(F.col("expected_label")))
        other = rows.where(~main & ~adversarial)
        kept = W.pair_ids(rows.where(main).withColumn("expected_label", label), keys)
        adv = adv.unionByName(other)
    none = adv.withColumn("minimal_pair_id", F.lit(None).cast("string"))
    out = kept.unionByName(none, allowMissingColumns=True)
    return out.withColumns({"is_adversarial_example": F.startswith("row_type", F.lit("adversarial_example")), "paraphrase_group_id": F.col("idiom_id")})


def merge_columns(position: str = "_pos") -> list:
    """What the merged rows are ordered by (SL2)."""
    return ["idiom_id", T.lookup(F.col("row_type"), ROW_ORDER, 99), "context_type", "example_usage_label", "idiom_in_example", position]


def merge_order(df: DataFrame, position: str = "_pos") -> DataFrame:
    """(SL2)"""
    return df.orderBy(*merge_columns(position))


def clean_examples(df: DataFrame, example: str = "example", idiom: str = "idiom_canonical", label: str = "example_usage_label", longer_than: int = 15) -> DataFrame:
    """Corrupted, empty and short examples go, trivial ones unless idiomatic; lengths are added (FLT29-FLT32, SC49)."""
    rows = df.where(~P.corrupted_example(example)).withColumn("example_normalized", T.example_normalized(example)).where("example_normalized <> ''")
    rows = rows.where(~P.trivial_example(example, idiom) | (F.lower(T.safe(label)) == "idiomatic"))
    rows = rows.withColumns({"sentence_length_chars": F.length(example), "sentence_length_words": T.token_count(example)})
    return rows.where(F.col("sentence_length_chars") > longer_than)


def clean_merged(df: DataFrame, example: str = "example", idiom: str = "idiom_canonical") -> DataFrame:
    """Examples equal to the idiom, and examples of several idioms, go (FLT33, FLT34): a grouped count, joined as an anti join.

    Each text is normalised once on either side; what is grouped and joined is the md5 of the result, not the text.
    """
    norms = {"__e": T.equality_normalized(example), "__i": T.equality_normalized(idiom)}
    rows = T.once(df, **norms).where("__e <> __i").withColumn("__e", F.unhex(F.md5(F.col("__e").cast("binary")))).drop("__i")
    shared = rows.groupBy("__e").agg(F.count_distinct(idiom).alias("n")).where("n > 1").select("__e")
    return rows.join(shared, "__e", "left_anti").drop("__e")


def repair_labels(df: DataFrame, borderline: bool | None = True, label: str = "example_usage_label", flag: str = "is_example_idiom") -> DataFrame:
    """Flag from label and label from flag; what is still missing is idiomatic (SC46)."""
    from_flag = F.when(F.col(flag), "idiomatic").when(~F.col(flag), "literal")
    new_label = F.coalesce(F.col(label), from_flag)
    new_flag = F.coalesce(F.col(flag), T.label_bool(F.col(label), borderline))
    return df.withColumns({label: F.coalesce(new_label, F.lit("idiomatic")), flag: F.coalesce(new_flag, F.lit(True))})


def fill_metadata(df: DataFrame) -> DataFrame:
    """Confidence by provenance, validity by status, slang strength by register, tags from metadata (SC15, SC47)."""
    complete = F.col("idiom_canonical").isNotNull() & F.col("example").isNotNull() & F.col("example_usage_label").isNotNull()
    status, register = F.coalesce("validation_status", F.lit("")), T.lower_norm("idiom_register")
    validity = F.when(complete & (status == "corrected"), "corrected_valid").when(complete & status.isin("verified", "valid", "final_ready"), "valid")
    slang = F.when(register == "slang", "high").when(register == "informal", "medium").when(register.isin("neutral", "formal", "archaic"), "none")
    parts = F.array_distinct(F.filter(F.transform(F.array("idiom_register", "idiom_domain", "row_type", "example_usage_label"), lambda t: T.safe(t)), lambda t: t != ""))
    return df.withColumns({
        "idiom_confidence": F.coalesce("idiom_confidence", T.lookup(F.col("record_origin"), PROVENANCE_CONFIDENCE)),
        "idiom_validity_label": F.coalesce("idiom_validity_label", validity),
        "slang_strength": F.coalesce("slang_strength", slang),
        "tags": F.when(T.safe("tags") == "", F.array_join(parts, ", ")).otherwise(F.col("tags")),
    })


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] = MODERN_DEFAULTS) -> DataFrame:
    """(SC48)"""
    from phraseloom.operators.schema import ensure_columns

    out = ensure_columns(df, dict.fromkeys(defaults))
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)) for c, v in defaults.items()})


def fill_pair_ids(df: DataFrame, position: str = "_pos") -> DataFrame:
    """Missing pair ids of main rows from idiom, context, label and the row's rank among those (WN5, SC56)."""
    keys = ["idiom_canonical", "context_type", "example_usage_label"]
    rows = W.numbered(df.withColumn("__main", F.col("row_type") == "main_example"), [*keys, "__main"], [position], "__rank", start=0)
    part = lambda c: F.lower(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), T.SPACES, "_"))
    new = F.concat(F.lit("mp_"), F.concat_ws("__", part("idiom_canonical"), part("context_type"), F.lower("example_usage_label"), F.col("__rank").cast("string")))
    return rows.withColumn("minimal_pair_id", F.when(F.col("__main"), F.coalesce("minimal_pair_id", new)).otherwise(F.col("minimal_pair_id"))).drop("__main", "__rank")


def add_quality(df: DataFrame, similarity: Column, high: float = 0.35, medium: float = 0.18) -> DataFrame:
    """Similarity and tier where missing (SC50-SC54)."""
    from phraseloom.operators.schema import ensure_columns

    out = ensure_columns(df, {"semantic_similarity_example_vs_meaning": None, "semantic_quality": None})
    out = out.withColumn("semantic_similarity_example_vs_meaning", F.coalesce(F.col("semantic_similarity_example_vs_meaning").try_cast("double"), similarity))
    return out.withColumn("semantic_quality", F.coalesce(F.nullif(T.safe("semantic_quality"), F.lit("")), S.tier("semantic_similarity_example_vs_meaning", high, medium)))


def below_quantile(df: DataFrame, column: str, share: float = 0.05) -> DataFrame:
    """Rows below a quantile of the column (FLT37): one aggregated row joined to all."""
    from phraseloom.operators.stats import exact_quantiles

    cut = exact_quantiles(df, column, (share,)).select(F.col("q0").alias("__cut"))
    return df.join(F.broadcast(cut), F.col(column) < F.col("__cut")).drop("__cut")  # one row is broadcast


def merge_branches(*branches: DataFrame, keys: Sequence[Column | str], priority: Sequence[str], column: str = "source_dataset", position: str = "_pos") -> DataFrame:
    """Union by name and one row per key, the branch listed first winning (DD15, DD17)."""
    from functools import reduce

    from phraseloom.operators.schema import align_union

    return D.by_priority(reduce(align_union, branches), keys, column, priority, position)


def variant_flags(df: DataFrame, example: str = "example", idiom: str = "idiom_canonical") -> DataFrame:
    """Idioms per example and raw forms per normalised idiom, as columns (AG23, JN7)."""
    from phraseloom.operators.joins import group_feature

    rows = group_feature(df, T.equality_normalized(example), idiom, "n_idioms_per_example")
    return group_feature(rows, T.equality_normalized(idiom), idiom, "n_variants_per_idiom_norm")
