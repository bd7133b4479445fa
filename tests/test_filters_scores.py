import pytest
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import predicates as P
from phraseloom.functions import scores as S
from phraseloom.functions import similarity as Sim
from phraseloom.functions import text as T
from phraseloom.functions.rules import cascade, score, steps


def value(spark, column, schema, *row):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("word,expected", [("break a leg", True), ("Template:x y", False), ("word", False), ("well-known", False), ("a b c d e f g h i", False), ("12 34", False), ("", False)])
def test_english_phrase(spark, word, expected):
    # one hyphenated token is a single token
    assert value(spark, P.english_phrase("word"), "word string", word) is expected


@pytest.mark.parametrize("idiom,expected", [("break a leg", True), ("BREAK A LEG", False), ("a/b c", False), ("a b c d e f g h", False), ("one", False)])
def test_strict_phrase(spark, idiom, expected):
    assert value(spark, P.strict_phrase("idiom"), "idiom string", idiom) is expected


@pytest.mark.parametrize("meaning,expected", [("Plural of x", False), ("to do well", True), ("", False), (None, False), ("form", True)])
def test_useful_sense(spark, meaning, expected):
    assert value(spark, P.useful_sense("m"), "m string", meaning) is expected


def test_explicit_is_a_substring_unless_asked(spark):
    assert value(spark, P.explicit("m"), "m string", "something odd") is True
    assert value(spark, P.explicit("m", word_boundary=True), "m string", "something odd") is False


@pytest.mark.parametrize("n,expected", [(7, False), (8, True), (180, True), (181, False)])
def test_mining_line_length(spark, n, expected):
    line = ("ab cd " * 40)[: n - 1] + "e"
    line = " ".join(["a" * ((n - 2) // 3), "b" * ((n - 2) // 3), "c" * (n - 2 - 2 * ((n - 2) // 3))])
    assert len(line) == n and value(spark, P.mining_line("t"), "t string", line) is expected


@pytest.mark.parametrize("text,expected", [("go to x", False), ("one", False), ("a b", True), ("a b c d e f g", False), (None, False)])
def test_generated_candidate(spark, text, expected):
    assert value(spark, P.generated_candidate("t"), "t string", text) is expected


@pytest.mark.parametrize("text,expected", [("meaning: x", True), ("a: b: " + "c" * 300, True), ("a: b: c", False), ("fine", False), (None, False)])
def test_corrupted(spark, text, expected):
    assert value(spark, P.corrupted_example("t"), "t string", text) is expected


def test_task_row_null_label_passes(spark):
    schema = "semantic_quality string, validation_status string, example_usage_label string"
    assert value(spark, P.task_row(), schema, "high", None, None) is True
    assert value(spark, P.task_row(), schema, "high", None, "borderline") is False
    assert value(spark, P.task_row(), schema, "low", "verified", "literal") is True
    assert value(spark, P.task_row(), schema, None, None, "literal") is False


def test_example_score_by_hand(spark):
    # 6 tokens: 3, not empty: 2, contains the phrase: 2
    c = S.example_score("e", F.lit("cut some slack"), (5, 16), (4, 20))
    assert value(spark, c, "e string", "Please cut some slack for me") == 7
    assert value(spark, c, "e string", "NO WAY [X]") == 1 + 2 - 2 - 2
    assert value(spark, c, "e string", None) == 1


def test_shape_and_lexical_score(spark):
    assert value(spark, S.shape_score("i"), "i string", "give it all up") == 2 + 2 + 2 + 3
    assert value(spark, S.lexical_score(T.tokens("i")), "i string", "cut some slack") == 2 + 2


def test_strong_pattern_lists_differ(spark):
    assert value(spark, S.strong_pattern(F.col("i")), "i string", "shut it up")
    assert not value(spark, S.strong_pattern(F.col("i"), L.MODERN_STRONG_PATTERNS), "i string", "shut it up")


@pytest.mark.parametrize("s,expected", [(0.35, "high"), (0.18, "medium"), (0.1799, "low"), (None, None)])
def test_tier(spark, s, expected):
    assert value(spark, S.tier("s"), "s double", s) == expected


def test_rules(spark):
    schema = "a int"
    assert value(spark, score((F.col("a") > 1, 2), (F.col("a") > 5, 3), (F.lit(None).cast("boolean"), 9)), schema, 3) == 2
    assert value(spark, steps((F.col("a") > 5, 3), (F.col("a") > 1, 2), otherwise=7), schema, 0) == 7
    assert value(spark, cascade([(F.col("a") > 1, "x"), (F.col("a") > 0, "y")], "z"), schema, 2) == "x"


def test_jaccard_and_ratio(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "a array<string>, b array<string>")
    assert [round(r[0], 4) for r in df.select(Sim.jaccard(F.col("a"), F.col("b"))).collect()] == [0.3333, 1.0, 0.0]
    import difflib

    pairs = [("to fail badly", "to fail very badly"), ("", "x"), ("same", "same")]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    got = [r[0] for r in df.select(Sim.sequence_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0]), (None, [1.0])], "a array<float>, b array<float>").coalesce(1)
    got = [r[0] for r in df.select(Sim.cosine("a", "b")).collect()]
    assert got[0] == 0 and abs(got[1] - 1) < 1e-12 and got[2] == 0 and got[3] is None and got[4] is None


@pytest.mark.parametrize("a,b,expected", [("cat mat", "cat dog", 0.202), ("cat mat", "cat mat", 1.0), ("cat", "dog", 0.0), ("", "dog", None), ("the of", "and in", None)])
def test_tfidf_pair(spark, a, b, expected):
    assert value(spark, Sim.tfidf_pair("a", "b"), "a string, b string", a, b) == expected
