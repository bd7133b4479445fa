"""Validation of enriched rows and of the groups they form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import text as T
from phraseloom.functions.rules import cascade

TEXTS = {"idiom_in_example": "missing_example_en", "idiom_in_example_arabic": "missing_example_arabic", "idiom_in_example_meaning_en": "missing_example_meaning_en", "idiom_in_example_meaning_arabic": "missing_example_meaning_arabic", "explanation_en": "missing_explanation_en", "explanation_ar": "missing_explanation_ar", "idiom_level_explanation_en": "missing_idiom_level_explanation_en", "idiom_level_explanation_ar": "missing_idiom_level_explanation_ar"}
LISTS = ("hard_negative_idioms", "meaning_paraphrases_en", "meaning_paraphrases_ar")
ISSUE = ("row_index", "problem", "idiom_id", "idiom_canonical", "row_type", "context_type", "example_usage_label", "expected_label", "idiom_surface", "idiom_in_example")


def row_problem(check_adversarial_label: bool = True) -> Column:
    """The first rule that a row breaks, or null (UD8): 17 for all rows, 9 for main rows, 6 for adversarial ones."""
    e = T.safe
    kind, label, context = e("row_type"), e("example_usage_label"), e("context_type")
    truth, adversarial = F.lower(e("is_example_idiom")), F.lower(e("is_adversarial_example"))
    missing = F.size(F.array_except(T.unicode_words("idiom_surface"), T.unicode_words("idiom_in_example")))
    rules = [(e("idiom_id") == "", "missing_idiom_id"), (e("idiom_canonical") == "", "missing_idiom_canonical"), (~kind.isin(*L.ROW_TYPES), "invalid_row_type"), (~context.isin(*L.CONTEXTS, "adversarial"), "invalid_context_type"), (~e("source_style").isin(*L.STYLES), "invalid_source_style")]
    rules += [(e(c) == "", name) for c, name in TEXTS.items()]
    rules += [(F.size(T.json_list(c)) < 3, f"missing_or_short_{c}") for c in LISTS]
    rules.append((T.token_count("idiom_in_example") < 2, "example_too_short"))
    main = kind == "main_example"
    rules += [(main & c, name) for c, name in (
        (~label.isin(*L.MAIN_LABELS), "invalid_main_example_usage_label"), (context == "adversarial", "main_example_cannot_have_adversarial_context"), (e("idiom_surface") == "", "missing_surface"), (missing > 1, "surface_not_in_example"), (F.col("is_example_idiom").isNull(), "missing_is_example_idiom"),
        ((label == "idiomatic") & ~truth.isin("true", "1"), "label_boolean_mismatch_idiomatic"), ((label == "literal") & ~truth.isin("false", "0"), "label_boolean_mismatch_literal"), (e("minimal_pair_id") == "", "missing_minimal_pair_id"), (~adversarial.isin("false", "0"), "main_example_marked_as_adversarial"))]
    rules += [(~main & c, name) for c, name in (
        ((~label.isin(*L.LABELS)) if check_adversarial_label else F.lit(False), "invalid_adversarial_example_usage_label"), (context != "adversarial", "adversarial_row_missing_adversarial_context"), (e("source_style") != "synthetic_adversarial", "invalid_adversarial_source_style"),
        (~e("adversarial_type").isin(*L.ADVERSARIAL_TYPES), "invalid_adversarial_type"), (~e("expected_label").isin(*L.LABELS), "invalid_expected_label"), (~adversarial.isin("true", "1"), "adversarial_row_not_marked_as_adversarial"))]
    return cascade(rules)


def validate_rows(df: DataFrame, check_adversarial_label: bool = True) -> DataFrame:
    """``df`` with ``problem`` (null if none) and ``validation_status`` valid or needs_review. Null text is missing text."""
    rows = df.withColumn("problem", row_problem(check_adversarial_label))
    return rows.withColumn("validation_status", F.when(F.col("problem").isNull(), "valid").otherwise("needs_review"))


def group_issues(df: DataFrame, main: int = 12, adversarial: int = 2, each: int = 6, pair: int = 2) -> DataFrame:
    """Issues of idioms (UD9): counts of main and adversarial rows, of both labels, and of each context's rows.

    One aggregate per idiom counts everything; the checks are unfolded from its row. Label and context checks need main rows.
    Null idiom ids form no group.
    """
    kind = F.coalesce(F.col("row_type"), F.lit(""))
    is_main = kind == "main_example"
    contexts = {c: F.count_if(is_main & (F.col("context_type") == c)).alias(f"context_{c}") for c in L.CONTEXTS}
    counts = df.where("idiom_id is not null").groupBy("idiom_id").agg(F.min("idiom_canonical").alias("idiom_canonical"), F.count_if(is_main).alias("main"), F.count_if(F.startswith(kind, F.lit("adversarial_example"))).alias("adv"), F.count_if(is_main & (F.col("example_usage_label") == "idiomatic")).alias("idiomatic"), F.count_if(is_main & (F.col("example_usage_label") == "literal")).alias("literal"), *contexts.values())
    some = F.col("main") > 0

    def check(bad: Column, problem: str, context: str, text: Column) -> Column:
        return F.when(bad, F.struct(F.lit(problem).alias("problem"), F.lit(context).alias("context_type"), text.alias("idiom_in_example")))

    say = lambda name, c: F.concat(F.lit(f"{name}="), F.col(c).cast("string"))
    checks = [check(F.col("main") != main, "unexpected_main_example_count_per_idiom", "", say("main_count", "main")), check(F.col("adv") != adversarial, "unexpected_adversarial_example_count_per_idiom", "", say("adv_count", "adv"))]
    checks += [check(some & (F.col(c) != each), f"unexpected_{c}_main_count_per_idiom", "", say(f"{c}_count", c)) for c in L.MAIN_LABELS]
    checks += [check(some & (F.col(f"context_{c}") != pair), "unexpected_context_pair_count_per_idiom", c, say("context_count", f"context_{c}")) for c in L.CONTEXTS]
    rows = counts.select("idiom_id", "idiom_canonical", F.inline(F.array_compact(F.array(*checks))))
    constant = {"row_index": F.lit(None).cast("long"), "row_type": F.lit("group_check"), "example_usage_label": F.lit(""), "expected_label": F.lit(""), "idiom_surface": F.lit("")}
    return rows.withColumns(constant).select(*ISSUE)


def issues(validated: DataFrame, row_index: str = "row_index") -> DataFrame:
    """Row issues and group issues in one table (UD10)."""
    rows = validated.where("problem is not null").withColumn("row_index", F.col(row_index).cast("long")).select(*ISSUE)
    return rows.unionByName(group_issues(validated))
