import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from phraseloom.functions import text as T
from phraseloom.operators import dedup as D
from phraseloom.operators import enrich as E
from phraseloom.operators import joins as J
from phraseloom.operators import mining as M
from phraseloom.operators import publish as Pub
from phraseloom.operators import schema as Sch
from phraseloom.operators import stats as St
from phraseloom.operators import windows as W
from phraseloom.sources import readers as R


def test_first_row_ignores_row_order(spark):
    rows = [(i, f"k{i % 3}", f"v{i}") for i in range(30)] + [(30, None, "n"), (31, None, "m")]
    want = {(0, "k0", "v0"), (1, "k1", "v1"), (2, "k2", "v2"), (30, None, "n")}
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "_pos long, k string, v string").repartition(5)
        got = D.first_row(df, ["k"])
        assert {tuple(r) for r in got.collect()} == want
        assert {tuple(r) for r in D.first_row(got, ["k"]).collect()} == want


def test_best_rows(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (2, "a", "y", 3), (3, "a", "y", 3), (4, "b", "", 0), (5, "a", "", 9)], "_pos long, i string, m string, s int")
    assert [r["_pos"] for r in D.best_scored(df, ["i"], F.col("s")).orderBy("_pos").collect()] == [4, 5]
    got = D.unique_pairs_plus_best(df, F.col("i"), F.col("m"), F.col("s"))
    assert {r["_pos"] for r in got.collect()} == {1, 2, 4, 5}
    assert {r["_pos"] for r in D.by_priority(df, ["i"], "m", ["y", "x"]).collect()} == {2, 4}
    assert D.duplicate_count(df, ["i", "m"]).first()[0] == 1


def test_schema_operators(spark):
    df = spark.createDataFrame([(" a ", "nan")], "idiom string, x string")
    out = Sch.blanks_to_null(Sch.ensure_columns(df, {"y": 1, "z": None}))
    assert out.columns == ["idiom", "x", "y", "z"] and out.first()["x"] is None
    assert Sch.reorder(out, ["z", "idiom"]).columns == ["z", "idiom", "x", "y"]
    assert Sch.schema_diff(df, out)["right_only"] == ["y", "z"]
    assert Sch.resolve(df, "nope", "x") == "x" and Sch.resolve(df, "nope") is None
    assert Sch.align_to(df, ["k", "idiom"], constants={"k": "c"}).first().asDict() == {"k": "c", "idiom": " a "}
    t = Sch.coerce_types(spark.createDataFrame([("high", "yes", "<NA>"), ("0.7", "0", "t")], "n string, b string, s string"), ["n"], ["b"], ["s"]).collect()
    assert [tuple(r) for r in t] == [(None, True, None), (0.7, False, "t")]


def test_match_status_all_seven(spark):
    schema = "_pos long, idiom string, meaning string, example string"
    main = spark.createDataFrame([(1, "spill the beans", "to reveal a secret", "He spilled it."), (2, "spill the beans", "to tell something that was hidden before", ""), (3, "no meaning", "its one meaning", "")], schema)
    new = spark.createDataFrame([
        (1, "", "m", "e"), (2, "Spill  the beans", "To reveal a secret", "“He spilled it.”"), (3, "spill the beans", "to reveal a secret", "other"), (4, "no meaning", "", "x"),
        (5, "spill the beans", "to tell something that was hidden before now", "e"), (6, "spill the beans", "a kind of soup", "e"), (7, "brand new one", "m", "e"), (8, "spill the beans", "to reveals a secret", "e")], schema)
    got = {r["_pos"]: (r["status"], r["matched_meaning"]) for r in J.match_status(new, main).collect()}
    assert got[1][0] == "remove_missing_idiom" and got[2][0] == "remove_exact_duplicate_of_main"
    assert got[3][0] == "remove_duplicate_idiom_meaning_of_main" and got[4][0] == "remove_existing_idiom_without_new_meaning"
    assert got[5] == ("remove_near_duplicate_meaning_of_main", "to tell something that was hidden before")
    assert got[6] == ("keep_new_meaning_for_existing_idiom", "") and got[7] == ("keep_new_idiom", "")
    assert got[8] == ("remove_near_duplicate_meaning_of_main", "to reveal a secret")


def test_fill_and_resolve(spark):
    df = spark.createDataFrame([("a", None), ("b", "own"), ("c", None)], "k string, s string")
    src = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, s string")
    got = {r["k"]: r["s"] for r in J.fill_from(df, src, "k", {"s": "s"}).collect()}
    assert got == {"a": "x", "b": "own", "c": None}
    raw = spark.createDataFrame([(0, "id_a", "r0"), (1, "id_b", "r1")], "_pos long, idiom_id string, v string")
    res = spark.createDataFrame([("id_b",), ("row_0",), ("nothing",), ("row_9",)], "custom_id string")
    assert {(r["custom_id"], r["raw"]["v"]) for r in J.resolve_ids(res, raw).collect()} == {("id_b", "r1"), ("row_0", "r0")}


def test_group_feature_keeps_null_keys(spark):
    df = spark.createDataFrame([("e", "a"), ("e", "b"), (None, "c")], "e string, i string")
    assert sorted((r["i"], r["n"]) for r in J.group_feature(df, "e", "i", "n").collect()) == [("a", 2), ("b", 2), ("c", 1)]


def test_fill_both_ways(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "a", None), (4, "b", None)], "_pos long, k string, m string")
    assert [r["m"] for r in W.fill_both_ways(df, "k", "m").orderBy("_pos").collect()] == ["x", "x", "x", None]


def test_pair_ids_run_over_sorted_pairs(spark):
    rows = [(f"i{i % 7:02d}", f"c{i % 3}") for i in range(60)] + [(None, "c0")]
    df = spark.createDataFrame(rows, "idiom_id string, context_type string").repartition(6)
    got = {(r[0], r[1]): r[2] for r in W.pair_ids(df, ["idiom_id", "context_type"]).collect()}
    order = sorted(k for k in set(rows) if k[0])
    assert all(got[k] == f"{k[0]}_pair_{n + 2}" for n, k in enumerate(order))  # the null pair comes first


def test_split_has_no_leakage_and_sample_is_stable(spark):
    df = spark.createDataFrame([(i, f"k{i % 50}") for i in range(500)], "i long, k string")
    parts = W.split_by_key(df, "k")
    assert W.split_overlap(parts, "k").first()[0] == 0 and parts.count() == 500
    a = [r["i"] for r in W.sample(df, "i", 20).collect()]
    assert a == [r["i"] for r in W.sample(df.repartition(7), "i", 20).collect()]


def test_numeric_summary(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert tuple(St.numeric_summary(df, "x").first()) == (4, 2.5, 1.291, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert tuple(St.numeric_summary(df.limit(1), "x").first())[2] == 0.0
    assert tuple(St.numeric_summary(df.where("x > 9"), "x").first()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_reports(spark):
    df = spark.createDataFrame([("a b", "m", None), ("a b", "", "x y"), ("c d", None, "")], "idiom string, meaning string, example string")
    report = {(r["section"], r["metric"]): r["value"] for r in St.full_report(df, ("idiom", "meaning", "example"), ["meaning"], {"len": F.length("idiom")}).collect()}
    assert report[("core", "total_rows")] == "3" and report[("core", "unique_idioms")] == "2" and report[("meaning", "MISSING")] == "1" and report[("missing", "example")] == "1"
    assert {r["column"]: r["nulls"] for r in St.null_audit(df).collect()} == {"meaning": 1, "example": 1}


def lines_of(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line_id long, text string")


def test_mining_counts_once_per_line(spark):
    line = "Please cut some slack today"
    df = lines_of(spark, *[line] * 4, "cut some slack and cut some slack now")
    got = {r["phrase"]: r for r in M.mine_phrases(df, 5).collect()}
    assert got["cut some slack"]["frequency_count"] == 5 and got["cut some slack"]["example"] == line
    assert M.mine_phrases(df, 6).where("phrase = 'cut some slack'").count() == 0


def test_mining_prunes_and_counts_exactly(spark):
    """Against plain counts, with a sketch so small that its buckets collide; repeats in a line count once."""
    r = random.Random(6)
    words = ["cut", "some", "slack", "break", "down", "carry", "on", "figure", "out", "hang", "up", "run", "away"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(3, 14))) for _ in range(150)] + ["cut some slack cut some slack cut some slack"] * 2
    df = lines_of(spark, *texts).repartition(3)
    every = {(x["phrase"], x["line_id"]) for x in M.occurrences(df).collect()}
    counts: dict = {}
    for phrase, _ in every:
        counts[phrase] = counts.get(phrase, 0) + 1
    want = {p: n for p, n in counts.items() if n >= 3}
    assert want and {x["phrase"]: x["frequency_count"] for x in M.mine_phrases(df, 3, size=256).collect()} == want
    assert {x["phrase"]: x["frequency_count"] for x in M.mine_phrases(df, 3).collect()} == want
    # at the full size nearly nothing else is unfolded
    kept = {x["phrase"] for x in M.frequent_occurrences(df, 3).collect()}
    assert set(want) <= kept < set(counts)
    assert [tuple(x) for x in M.top_candidates(df, 5).collect()][0][1] == max(counts.values())
    stats = M.mining_statistics(df, 3).first()
    assert (stats["candidates"], stats["frequent_phrases"]) == (len(counts), len(want))


def test_rare_trigrams_do_not_fill_the_sketch(spark):
    word = lambda i: "".join(chr(97 + int(c)) for c in str(10_000 + i))
    rare = [" ".join(word(i * 7 + k) for k in range(7)) for i in range(300)]
    df = lines_of(spark, *rare, *["blow the candles off now"] * 3)
    # 1,500 trigrams of one line each would fill a sketch of 64 buckets; those of three lines set three bits at most
    kept = M.frequent_occurrences(df, 3, size=64)
    assert kept.where("phrase = 'blow the candles off'").count() == 3 and 9 <= kept.count() < 300
    assert M.sketch_size(0) == M.sketch_size(10) == M.SKETCH < M.sketch_size(M.SKETCH // 4) < M.sketch_size(10**12) == M.LARGEST_SKETCH


def test_mining_looks_at_twenty_examples(spark):
    good = "I said that you must cut some slack"
    df = lines_of(spark, *["cut some slack"] * 20, good)
    assert {r["phrase"]: r["example"] for r in M.mine_phrases(df, 5).collect()}["cut some slack"] == "cut some slack"
    assert {r["phrase"]: r["example"] for r in M.mine_phrases(lines_of(spark, *["cut some slack"] * 19, good), 5).collect()}["cut some slack"] == good


def result(spark, *records):
    import json

    rows = []
    for k, r in records:
        text = r if isinstance(r, str) else json.dumps(r)
        rows.append((json.dumps({"custom_id": k, "response": {"body": {"model": "m", "output": [{"type": "message", "content": [{"type": "output_text", "text": text}]}]}}}),))
    return spark.createDataFrame(rows, "value string")


def test_parse_and_flatten(spark):
    record = {"is_idiom": True, "idiom_validity_label": "valid_idiom", "idiom_canonical": "x", "hard_negative_idioms": ["a"], "examples": [{"context_type": "formal", "idiom_in_example": f"e{i}", "example_usage_label": "literal", "is_example_idiom": False} for i in range(2)], "adversarial_examples": [{"idiom_in_example": "adv", "expected_label": "borderline"}]}
    lines = result(spark, ("k1", record), ("k2", "Sure! " + __import__("json").dumps(record) + " bye"), ("k3", "broken {"), ("k4", {"is_idiom": False, "idiom_canonical": "y"}))
    parsed = E.parse_results(lines)
    assert tuple(E.parse_counts(parsed).first()) == (3, 1)
    core = E.flatten_core(parsed)
    assert core.where("row_type = 'main_example'").count() == 4
    adv = core.where("idiom_id = 'k1' and row_type = 'adversarial_example_1'").first()
    assert adv["expected_label"] == "borderline" and adv["is_example_idiom"] is None and adv["minimal_pair_id"] is None
    ext = E.flatten_extended(parsed)
    assert ext.where("row_type = 'idiom_only'").first()["idiom_id"] == "k4"
    assert ext.where("row_type = 'adversarial_example'").first()["idiom_surface"] == "x"
    import hashlib

    assert core.where("row_type = 'main_example' and idiom_id = 'k1'").first()["minimal_pair_id"] == "pair_" + hashlib.md5(b"k1||formal").hexdigest()[:12]


def test_extended_rows_parse_each_record_once(spark):
    from phraseloom.plans import pipelines as Plan

    record = '{"is_idiom": true, "idiom_canonical": "x", "idiom_validity_label": "valid_idiom", "examples": [{"context_type": "c", "idiom_in_example": "e", "example_usage_label": "literal"}], "adversarial_examples": null}'
    import json

    line = json.dumps({"custom_id": "k", "response": {"body": {"model": "m", "output": [{"type": "message", "content": [{"type": "output_text", "text": record}]}]}}})
    parsed = E.parse_results(spark.createDataFrame([(line,)], "value string"))
    rows = E.flatten_extended(parsed)
    assert [(r["row_type"], r["at"], r["idiom_in_example"], r["is_example_idiom"]) for r in rows.collect()] == [("main_example", 0, "e", None)]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "union" not in plan(rows)
    assert "pythonudf" not in plan(Plan.enriched(parsed)) and "from_json" not in plan(Plan.enriched(parsed))


def test_verdicts(spark):
    cols = ", ".join(f"{c} string" for c in E.CORRECTED)
    base = {c: "old" for c in E.CORRECTED} | {"example_usage_label": "literal", "expected_label": "literal"}
    rows = [(i, kind, "needs_review", *base.values()) for i, kind in enumerate(["main_example"] * 4 + ["adversarial_example_1"] * 2)]
    df = spark.createDataFrame(rows, f"row_index long, row_type string, validation_status string, {cols}")
    new = tuple({c: "new" for c in E.CORRECTED} | {"example_usage_label": "borderline", "expected_label": "idiomatic"} for _ in range(1))[0]
    verdicts = spark.createDataFrame([(0, True, False, None, None), (1, False, False, None, None), (2, False, True, tuple(new.values()), None), (3, False, True, None, "timeout"), (4, False, True, tuple(new.values()), None)], f"row_index long, is_valid boolean, correction_needed boolean, corrected struct<{cols.replace(' string', ':string')}>, error string")
    done = E.apply_verdicts(df, verdicts)
    got = {r["row_index"]: r for r in done.collect()}
    assert [got[i]["validation_status"] for i in range(6)] == ["verified", "invalid", "corrected", "verification_error: timeout", "corrected", "needs_review"]
    assert got[2]["example_usage_label"] == "literal" and got[2]["expected_label"] == "literal" and got[2]["idiom_in_example"] == "new"
    assert got[4]["example_usage_label"] == "idiomatic"
    assert E.verdict_log(df, done).count() == 5
    assert E.unprocessed(df, verdicts).count() == 1


def test_finalize_versions(spark):
    cols = "_pos long, idiom_id string, row_type string, context_type string, example_usage_label string, expected_label string, idiom_surface string, idiom_in_example string, adversarial_type string"
    rows = [(1, "i", "main_example", "formal", "idiomatic", "", "s", "short", ""), (2, "i", "main_example", "formal", "idiomatic", "", "s", "longer one", ""), (3, "i", "main_example", "formal", "literal", "", "s", "lit", ""), (4, "i", "main_example", "question", "literal", "", "s", "alone", ""),
            (5, "i", "adversarial_example", "adversarial", "", "odd", "", "zz", "b"), (6, "i", "adversarial_example", "adversarial", "", "literal", "", "a long example", "a"), (7, "i", "adversarial_example", "adversarial", "", "", "", "", "a"), (8, "i", "idiom_only", "", "", "", "", "", "")]
    df = spark.createDataFrame(rows, cols)
    v2 = {r["_pos"]: r for r in Pub.finalize(df).collect()}
    assert set(v2) == {2, 3, 4, 5, 6} and v2[4]["minimal_pair_id"] is None and v2[2]["minimal_pair_id"] == v2[3]["minimal_pair_id"] == "i_pair_1"
    assert v2[6]["row_type"] == "adversarial_example_1" and v2[5]["expected_label"] == "borderline" and v2[2]["is_example_idiom"] is True
    v1 = {r["_pos"]: r for r in Pub.finalize(df, version="v1").collect()}
    assert set(v1) == {1, 2, 3, 4, 6, 7, 8} and v1[4]["minimal_pair_id"] == "i_pair_2"
    gen = {r["_pos"]: r["row_type"] for r in Pub.finalize(df, version="generated").collect()}
    assert gen[7] == "adversarial_example_1" and gen[6] == "adversarial_example_2" and 5 not in gen


def test_label_repair_and_metadata(spark):
    df = spark.createDataFrame([("borderline", None), (None, False), (None, None)], "example_usage_label string, is_example_idiom boolean").coalesce(1)
    assert [tuple(r) for r in Pub.repair_labels(df).collect()] == [("borderline", True), ("literal", False), ("idiomatic", True)]
    cols = "idiom_canonical string, example string, example_usage_label string, validation_status string, idiom_register string, idiom_domain string, row_type string, record_origin string, idiom_confidence string, idiom_validity_label string, slang_strength string, tags string"
    r = Pub.fill_metadata(spark.createDataFrame([("i", "e", "literal", "corrected", "Slang", "d", "main_example", "modern_pipeline", None, None, None, " ")], cols)).first()
    assert (r["idiom_confidence"], r["idiom_validity_label"], r["slang_strength"], r["tags"]) == ("high", "corrected_valid", "high", "Slang, d, main_example, literal")


def test_example_cleaning_keeps_complement(spark):
    df = spark.createDataFrame([("a: meaning: x", "i j", "literal"), ("I  J!", "i j", "idiomatic"), ("i j", "i j", "literal"), ("A longer example text", "i j", "literal"), ("fifteen chars..", "z", "literal"), ("!!!", "z", "literal")], "example string, idiom_canonical string, example_usage_label string")
    assert [r["example"] for r in Pub.clean_examples(df, longer_than=4).orderBy("example").collect()] == ["A longer example text", "I  J!", "fifteen chars.."]
    assert [r["example"] for r in Pub.clean_examples(df).collect()] == ["A longer example text"]


def test_ambiguous_examples_go(spark):
    df = spark.createDataFrame([("Same one.", "a"), ("same one", "b"), ("other", "a"), ("a", "A!")], "example string, idiom_canonical string")
    assert [r["example"] for r in Pub.clean_merged(df).collect()] == ["other"]
    assert T is not None


def test_exact_quantiles(spark):
    r = random.Random(1)
    for n in (1, 2, 3, 5, 40, 333):
        for values in ([r.random() for _ in range(n)], [float(r.randint(0, 3)) for _ in range(n)]):
            got = St.exact_quantiles(spark.createDataFrame([(x,) for x in [*values, None]], "x double"), "x", (0.05, 0.25, 0.5, 0.75, 1.0)).first()
            assert np.allclose(list(got)[1:], np.quantile(values, [0.05, 0.25, 0.5, 0.75, 1.0])) and got["n"] == n
    assert St.exact_quantiles(spark.createDataFrame([], "x double"), "x", (0.5,)).first()["q0"] is None


def ranges_of(spark, df, order):
    """How many ranges there are where Spark does not put small ones together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return W.ranges(df, order).select("__range").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_fills_of_one_large_key_spread_over_ranges(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "b", None]) if i % 2 else "a", r.choice([None, None, None, f"v{i}"])) for i in range(400)]
    df = spark.createDataFrame(rows, "_pos long, k string, v string").repartition(4)
    want = {}
    for key in ("a", "b", None):
        own = [(p, v) for p, k, v in rows if k == key]
        for n, (p, _) in enumerate(own):
            before, after = [v for _, v in own[: n + 1] if v], [v for _, v in own[n:] if v]
            want[p] = before[-1] if before else after[0] if after else None
    assert {x["_pos"]: x["v"] for x in W.fill_both_ways(df, "k", "v").collect()} == want
    assert ranges_of(spark, df.where("k = 'a'"), ["k", "_pos"]) > 1


def test_fills_read_no_frame_again_for_each_row(spark):
    """Frames up to the end of a group cost its square; values are those of plain Python."""
    r = random.Random(5)
    rows = [(i, "ab"[i % 3 == 0], r.choice([None, None, None, f"v{i}"])) for i in range(3000)]
    got = W.fill_both_ways(spark.createDataFrame(rows, "_pos long, k string, v string").repartition(5), "k", "v")
    assert "unboundedfollowing" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    want = {}
    for k in "ab":
        own, last = [x for x in rows if x[1] == k], None
        for i, _, v in own:
            last = v or last
            want[i] = last
        first = next(v for _, _, v in own if v)
        want |= {i: first for i, _, _ in own if want[i] is None}
    assert {x["_pos"]: x["v"] for x in got.collect()} == want


def test_running_numbers_follow_the_whole_order(spark):
    r = random.Random(3)
    rows = [(i, "a prefix of more than thirty characters" + r.choice(["", "x", "y"]), r.choice([None, 1, 2])) for i in range(500)]
    df = spark.createDataFrame(rows, "_pos long, k string, n int").repartition(7)
    got = {x["_pos"]: x["place"] for x in W.running_number(df, ["k", F.desc("n"), "_pos"], "place").collect()}
    order = sorted(rows, key=lambda x: (x[1], -(x[2] or -1), x[0]))
    assert got == {x[0]: n + 1 for n, x in enumerate(order)}
    assert W.running_number(df.limit(0), ["k"], "place").count() == 0
    assert ranges_of(spark, df, ["k", "_pos"]) > 1


def test_pair_ids_of_keys_with_a_long_common_prefix(spark):
    keys = [(f"a-very-long-common-prefix-{k:03d}", c) for k in range(30) for c in ("x", "y")]
    df = spark.createDataFrame([(*k, n) for k in keys for n in (1, 2)], "idiom_id string, context_type string, n int").repartition(3)
    got = {(x["idiom_id"], x["context_type"]): x["minimal_pair_id"] for x in W.pair_ids(df, ["idiom_id", "context_type"]).collect()}
    assert got == {k: f"{k[0]}_pair_{n + 1}" for n, k in enumerate(sorted(keys))}
    one = spark.createDataFrame([("only", "x", 1)], "idiom_id string, context_type string, n int")
    assert W.pair_ids(one, ["idiom_id", "context_type"]).first()["minimal_pair_id"] == "only_pair_1"


def test_line_numbers_of_files(spark, tmp_path):
    files = {f"f{k}.txt": [f"line {k} {i}" for i in range(50 * k)] for k in (1, 2, 5)}
    for name, own in files.items():
        (tmp_path / name).write_text("\n".join(own) + "\n")
    got = {(x["file"].rsplit("/", 1)[-1], x["row"]): x["text"] for x in R.read_lines(spark, f"{tmp_path.as_uri()}/").collect()}
    assert got == {(name, i): t for name, own in files.items() for i, t in enumerate(own)}


def test_first_wins_by_the_order_of_the_input(spark):
    rows = spark.createDataFrame([(n, f"s{n}", "same") for n in (5, 3, 9)], "place long, v string, k string").withColumn("_pos", F.struct("place", "v"))
    assert D.first_row(rows, ["k"]).first()["v"] == "s3"


@pytest.mark.parametrize("block_rows", [2048, 4])
def test_near_meanings_against_brute_force(spark, block_rows):
    from difflib import SequenceMatcher

    from phraseloom.operators import near

    r = random.Random(1)
    words = [f"w{i}" for i in range(12)] + ["to", "tell", "a", "secret", "gradually", "!!"]
    text = lambda: " ".join(r.choice(words) for _ in range(r.randrange(1, 9)))
    new = {(r.choice("ab"), text()) for _ in range(60)} | {("a", "?!"), ("a", "x" * 30), ("c", "alone")}
    main = {(k, t[: r.randrange(len(t) + 1)] + r.choice(["", "s", " a"]) + t[r.randrange(len(t)) :]) for k, t in new for _ in range(2)} | {(r.choice("ab"), text()) for _ in range(60)} | {("a", "--"), ("d", "alone")}
    main = {(k, t) for k, t in main if t}
    tokens = lambda t: set(re.findall(r"[A-Za-z0-9]+(?:'[A-Za-z0-9]+)?", t.lower()))

    def jaccard(x, y):
        return len(x & y) / len(x | y) if x | y else 1.0

    df = lambda rows: spark.createDataFrame(sorted(rows), "key string, text string").repartition(3)
    pairs = [(k, t, o) for k, t in new for j, o in main if k == j]
    ratio = {(k, t, o) for k, t, o in pairs if SequenceMatcher(None, t, o).ratio() >= 0.92}
    similar = {(k, t, o) for k, t, o in pairs if jaccard(tokens(t), tokens(o)) >= 0.85}
    assert ratio and similar
    assert {tuple(x) for x in near.jaccard_pairs(df(new), df(main)).collect()} == similar
    assert {tuple(x) for x in near.ratio_pairs(df(new), df(main), block_rows=block_rows).collect()} == ratio
    assert {tuple(x) for x in near.near_pairs(df(new), df(main), block_rows=block_rows).collect()} == ratio | similar
    # what is measured in Python is a small part of all pairs
    assert len(ratio) <= near.ratio_pairs(df(new), df(main), block_rows=block_rows, measured=True).count() < len(pairs) / 4


def test_one_idiom_of_many_meanings(spark):
    from phraseloom.operators import near

    base = spark.range(3000).selectExpr("'hot' AS key", "concat('meaning ', sha2(cast(id as string), 256)) AS text")
    other = base.withColumn("text", F.concat("text", F.lit("s")))
    assert near.ratio_pairs(base, other, block_rows=512).count() == 3000


def test_crawl_over_stored_pages(spark):
    from collections import deque

    r = random.Random(4)
    web = {f"t{i}": [f"t{r.randrange(60)}" for _ in range(r.randrange(5))] for i in range(40)}
    links = spark.createDataFrame([(t, n, o) for t, own in web.items() for n, o in enumerate(own)], "term string, at int, other string").repartition(3)
    pages = spark.createDataFrame([(t,) for t in web], "term string")
    seeds = spark.createDataFrame([("t5", 0), ("t50", 1), ("t3", 2), ("t5", 3)], "term string, at int")
    queue, seen, want = deque([("t5", 0), ("t3", 0)]), {"t5", "t3"}, []
    while queue:
        term, depth = queue.popleft()
        want.append((len(want), term, depth))
        for o in web[term]:
            if o in web and o not in seen:
                seen.add(o)
                queue.append((o, depth + 1))
    rows = lambda *a: sorted(tuple(x) for x in J.crawl_stored(pages, links, seeds, *a).collect())
    assert rows(1000) == want and rows(7) == want[:7] and rows(1000, 1) == [w for w in want if w[2] <= 1]
    assert J.crawl_stored(pages, links, seeds.limit(0), 5).count() == 0


def test_modern_inventory_is_new_against_the_main_one(spark):
    from phraseloom.plans import pipelines as Plan

    columns = "_pos long, idiom string, meaning_en string, example string, source string, idiom_confidence string, tags string, pos string"
    row = lambda i, idiom, meaning: (i, idiom, meaning, "an example of it", "urban_dictionary", "low", "slang", "phrase")
    high = spark.createDataFrame([row(1, "spill the tea", "to tell a secret"), row(2, "touch grass", "to go outside")], columns)
    broad = spark.createDataFrame([row(1, "spill the tea", "to tell a secret"), row(3, "no cap", "no lie"), row(4, "No  cap", "without any lie at all"), row(5, "hit the hay", "to go to bed now")], columns)
    main = spark.createDataFrame([(1, "touch grass", "to go outside", ""), (2, "hit the hay", "to go to bed now.", "")], "_pos long, idiom string, meaning string, example string")
    got = Plan.modern_inventory(broad, high, main)
    assert got.columns == high.columns and sorted(r["_pos"] for r in got.collect()) in ([1, 3], [1, 4])


def test_validated_rows_and_issues(spark):
    from phraseloom import queries
    from phraseloom.plans import pipelines as Plan

    rows = queries.enriched(spark, "/root/testdata/sf0.001")
    done, issues = Plan.validated(rows)
    assert done.count() == rows.count() and issues.count() >= done.where("problem <> ''").count() > 0
