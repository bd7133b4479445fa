import pytest
from pyspark.sql import functions as F

from phraseloom.functions import text as T

CASES = [
    (T.safe, "\t a  b ", "a  b"),
    (T.safe, None, ""),
    (T.norm, " a \tb \n", "a b"),
    (T.idiom_key, " Don’t  Go", "don't go"),
    (T.example_key, "He said “Hi” `x`", "he said hi x"),
    (T.example_normalized, "Café déjà, vu!", "café déjà vu"),
    (T.equality_normalized, "a-b,c", "a b c"),
    (T.tidy_example, "“Hi” , you ’ll !", "\"Hi\", you 'll!"),
    (T.token_count, "", 0),
    (T.token_count, " a  b ", 2),
    (T.word_count, "a b c", 3),
    (T.slug, " a  b c ", "a_b_c"),
    (T.tag_list, "slang, informal,slang,,", ["slang", "informal"]),
    (T.words, "It's 5 o'clock NOW", ["it's", "o'clock", "now"]),
    (T.dialogue_line, "00:01:02,000 --> 00:01:03,000", ""),
    (T.dialogue_line, "JOHN: hello there you", "hello there you"),
    (T.dialogue_line, "- [noise] cut me some ‘slack’", "cut me some 'slack'"),
    (T.dialogue_line, " 42 ", ""),
    (T.dialogue_line, "01:02", ""),
    (T.nullable_bool, "True", True),
    (T.nullable_bool, "no", False),
    (T.nullable_bool, "<NA>", None),
    (T.json_list, '["a","b"]', ["a", "b"]),
    (T.json_list, "plain", ["plain"]),
    (T.json_list, None, []),
    (T.json_salvage, 'Sure: {"a": 1} done', '{"a": 1}'),
    (T.json_salvage, "no json", None),
]


@pytest.mark.parametrize("function,value,expected", CASES)
def test_text(spark, function, value, expected):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(function("t").alias("x")).first()["x"] == expected


def test_ids_urls_and_parts(spark):
    df = spark.createDataFrame([("Break  A leg", "good luck"), (" break a LEG", "Good  luck")], "a string, b string")
    rows = df.select(T.short_id("idiom_", "a", "b").alias("id"), T.page_url("https://x/", "a").alias("url"), T.dedup_key("a", "b").alias("key")).collect()
    assert rows[0]["id"] == rows[1]["id"] and len(rows[0]["id"]) == len("idiom_") + 12
    assert rows[0]["url"] == "https://x/Break%20A%20leg"
    assert rows[0]["key"] == "break a leg || good luck"


def test_first_nonempty_and_tags(spark):
    df = spark.createDataFrame([(["", "  a  b "], ["c"]), (None, ["x"]), ([], None)], "a array<string>, b array<string>")
    got = df.select(T.first_nonempty(F.col("a"), F.col("b")).alias("x"), T.merge_tags(F.col("b"), F.col("a")).alias("t")).collect()
    assert [r["x"] for r in got] == ["a b", "x", ""]
    assert [r["t"] for r in got] == ["c,a b", "x", ""]


def test_safe_div_and_lookup(spark):
    df = spark.createDataFrame([(1, 3, "high"), (1, 0, "odd"), (1, None, None)], "a int, b int, c string")
    got = df.select(T.safe_div(F.col("a"), F.col("b")).alias("q"), T.lookup(F.col("c"), {"high": 3}, 0).alias("l")).collect()
    assert [(r["q"], r["l"]) for r in got] == [(0.333333, 3), (0.0, 0), (0.0, 0)]


REPAIRS = [
    ("{'a': 'x', 'b': 'y'}", '{"a": "x", "b": "y"}'),
    ("{'a': 'don't stop', 'b': 1}", '{"a": "don\'t stop", "b": 1}'),
    ('{a: 1, b_c: "x"}', '{"a": 1, "b_c": "x"}'),
    ('{"a": "x" "b": "y"}', '{"a": "x", "b": "y"}'),
    ('{"a": 1\n"b": 2}', '{"a": 1, "b": 2}'),
    ('{"a" 1, "b": 2}', '{"b": 2}'),
    ('{"a": None, "b": True, "c": false}', '{"a": null, "b": true, "c": false}'),
    ('{"a": 1, // note\n "b": 2 /* c */, # d\n"c": 3}', '{"a": 1, "b": 2, "c": 3}'),
    ('{"a": [1, 2, {"d": "[ open', '{"a": [1, 2, {"d": "[ open"}]}'),
    ('{"a": "she said "hi" to me", "b": 1}', '{"a": "she said \\"hi\\" to me", "b": 1}'),
    ('{"a": ["x" "y", "z",]}', '{"a": ["x", "y", "z"]}'),
    ('{"a": [1, {"b": 2], "c": 3}', '{"a": [1, {"b": 2}], "c": 3}'),
    ('so ```json\n{"a": 1, "b": ["t"\n```', '{"a": 1, "b": ["t"]}'),
    ("{“a”: “b”}", '{"a": "b"}'),
    ('{"a": "\\ud83d\\ude00 \\q", }', '{"a": "😀 q"}'),
    ('{"a": 007, "b": -1.5}', '{"a": "007", "b": -1.5}'),
    ('{"a": "x", "b', '{"a": "x"}'),
    ("{ }", "{ }"), ('{"a": {}', None), ('{,}', None), ('{"a":', None), ("no json", None), ("", None), (None, None), ("{" * 3000, None),
]


def test_repair_of_json(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(REPAIRS)], "i int, t string")
    got = {r["i"]: r["x"] for r in df.select("i", T.json_repaired("t").alias("x")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(REPAIRS)}
    lists = spark.createDataFrame([("x [1, 'two', {a: 3}",), ('{"a": [1]}',)], "t string").select(T.json_repaired("t", "array").alias("x")).collect()
    assert [r["x"] for r in lists] == ['[1, "two", {"a": 3}]', "[1]"]


def test_whole_json_is_left_as_it_is(spark):
    df = spark.createDataFrame([('{"a":1 }',), ('Sure: {"a": 1} done',)], "t string")
    assert [r[0] for r in df.select(T.json_repaired("t")).collect()] == ['{"a":1 }', '{"a": 1}']
