import pytest
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.operators import validate as V

MAIN = {"idiom_id": "i", "idiom_canonical": "x", "row_type": "main_example", "context_type": "formal", "source_style": "synthetic_formal", "idiom_in_example": "the beans spill", "idiom_in_example_arabic": "a", "idiom_in_example_meaning_en": "m", "idiom_in_example_meaning_arabic": "m", "explanation_en": "e", "explanation_ar": "e", "idiom_level_explanation_en": "e", "idiom_level_explanation_ar": "e", "hard_negative_idioms": '["a","b","c"]', "meaning_paraphrases_en": '["a","b","c"]', "meaning_paraphrases_ar": '["a","b","c"]', "example_usage_label": "idiomatic", "expected_label": "idiomatic", "is_example_idiom": "True", "is_adversarial_example": "0", "minimal_pair_id": "p", "adversarial_type": "", "idiom_surface": "spill the beans"}
ADVERSARIAL = MAIN | {"row_type": "adversarial_example_1", "context_type": "adversarial", "source_style": "synthetic_adversarial", "is_adversarial_example": "True", "adversarial_type": "negation", "idiom_surface": None, "minimal_pair_id": None, "is_example_idiom": None}
CASES = [
    (MAIN, {}, None), (ADVERSARIAL, {}, None),
    (MAIN, {"idiom_id": None}, "missing_idiom_id"), (MAIN, {"idiom_canonical": " "}, "missing_idiom_canonical"), (MAIN, {"row_type": "x"}, "invalid_row_type"), (MAIN, {"context_type": "x"}, "invalid_context_type"), (MAIN, {"source_style": "x"}, "invalid_source_style"),
    *[(MAIN, {c: None}, name) for c, name in V.TEXTS.items()],
    *[(MAIN, {c: '["a","b"]'}, f"missing_or_short_{c}") for c in V.LISTS],
    (MAIN, {"idiom_in_example": "word"}, "example_too_short"), (MAIN, {"example_usage_label": "borderline"}, "invalid_main_example_usage_label"), (MAIN, {"context_type": "adversarial"}, "main_example_cannot_have_adversarial_context"), (MAIN, {"idiom_surface": ""}, "missing_surface"),
    (MAIN, {"idiom_surface": "spill other things"}, "surface_not_in_example"), (MAIN, {"idiom_surface": "spill things"}, None), (MAIN, {"is_example_idiom": None}, "missing_is_example_idiom"), (MAIN, {"is_example_idiom": "False"}, "label_boolean_mismatch_idiomatic"),
    (MAIN, {"example_usage_label": "literal"}, "label_boolean_mismatch_literal"), (MAIN, {"minimal_pair_id": None}, "missing_minimal_pair_id"), (MAIN, {"is_adversarial_example": "1"}, "main_example_marked_as_adversarial"),
    (ADVERSARIAL, {"example_usage_label": "x"}, "invalid_adversarial_example_usage_label"), (ADVERSARIAL, {"context_type": "formal"}, "adversarial_row_missing_adversarial_context"), (ADVERSARIAL, {"source_style": "synthetic_formal"}, "invalid_adversarial_source_style"), (ADVERSARIAL, {"adversarial_type": "x"}, "invalid_adversarial_type"), (ADVERSARIAL, {"expected_label": ""}, "invalid_expected_label"), (ADVERSARIAL, {"is_adversarial_example": "0"}, "adversarial_row_not_marked_as_adversarial"),
    (MAIN, {"idiom_id": "", "idiom_in_example": "word"}, "missing_idiom_id"),
]


@pytest.fixture(scope="module")
def problems(spark):
    schema = "n int, " + ", ".join(f"{c} string" for c in MAIN)
    df = spark.createDataFrame([(n, *(base | change).values()) for n, (base, change, _) in enumerate(CASES)], schema)
    return {r["n"]: r["problem"] for r in V.validate_rows(df).collect()}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_row_rule(problems, n):
    assert problems[n] == CASES[n][2]


def group(spark, main, adversarial):
    rows = [MAIN | {"context_type": c, "example_usage_label": label} for c, label in main] + [ADVERSARIAL] * adversarial
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in MAIN))
    return {(r["problem"], r["context_type"]) for r in V.group_issues(df).collect()}


def test_groups(spark):
    full = [(c, label) for c in L.CONTEXTS for label in L.MAIN_LABELS]
    assert group(spark, full, 2) == set()
    assert group(spark, full[1:], 1) == {("unexpected_main_example_count_per_idiom", ""), ("unexpected_adversarial_example_count_per_idiom", ""), ("unexpected_idiomatic_main_count_per_idiom", ""), ("unexpected_context_pair_count_per_idiom", "dialogue")}
    assert group(spark, [], 2) == {("unexpected_main_example_count_per_idiom", "")}
    assert F is not None
