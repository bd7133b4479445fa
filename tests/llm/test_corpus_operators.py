"""Deduplication, mixing, neighbours, classifiers and the pipeline against brute force and planted cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from phraseloom.llm import ann, components, exact_dedup, mixing, quality, simhash, toxicity

SCHEMA = "doc_id long, text string, source string, kept string, sha string, id string, size string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    """Rows (doc_id, text, source); the extra columns have names that operators use."""
    return spark.createDataFrame([(*r, "k", "s", "i", "z") for r in rows], SCHEMA).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


DEDUP = [(1, "Same text", "a"), (2, "same TEXT", "a"), (3, "other", "a"), (4, None, "a"), (5, "", "a"), (6, "ÀB", "a"), (7, "àb", "a"), (8, "x" * 200 + "1", "a"), (9, "x" * 200 + "2", "a"), (10, "x" * 200 + "1", "a"), (None, "other", "a"), (None, "alone", "a")]


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_exact_dedup(spark, monkeypatch, broadcast):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", broadcast)
    got = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.exact_dedup(docs_of(spark, DEDUP)).collect()}
    groups = {}
    for i, t, _ in DEDUP:
        groups.setdefault(lower(t), []).append(i)
    assert len(got) == len(DEDUP)
    for i, t, _ in DEDUP:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        r = got[i, hashlib.sha256(lower(t).encode()).hexdigest()]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(ids), i == keep)
    kept = exact_dedup.drop_exact_copies(docs_of(spark, DEDUP))
    assert kept.columns == docs_of(spark, []).columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, [2, 3, 5, 6, 7, 9, 10, None]))


def test_exact_dedup_of_repeated_rows_keeps_one(spark):
    df = docs_of(spark, [(1, "a b", "s")] * 3 + [(0, "a b", "s"), (7, "alone", "s")])
    assert sorted((r["doc_id"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect()) == [(0, False), (1, False), (1, False), (1, True), (7, True)]
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_copies(df).collect()) == [1, 7]
    assert exact_dedup.exact_dedup(docs_of(spark, [])).count() == 0


def plain_fingerprint(text):
    w = WORDS.findall(lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    arr = np.array(list(fps.values()), dtype=np.uint64)
    near = [np.flatnonzero(np.bitwise_count(arr ^ x) <= 2) for x in arr]
    labels = np.arange(len(arr))
    while True:
        new = np.array([labels[n].min() for n in near])
        if (new == labels).all():
            return dict(zip(fps, labels, strict=True))
        labels = new


def test_simhash_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["the", "of", "And", "tion", "über", "été", " x", "a\x0bb"]
    base = [" ".join(r.choice(vocabulary) + str(r.randint(0, 40)) for _ in range(r.randint(1, 300))) for _ in range(60)]
    rows = [(i, t, "s") for i, t in enumerate(base + [b + " end" for b in base[:20]] + [b.upper().replace("Ü", "ü").replace("É", "é") for b in base[20:30]] + ["", None, "one", "one two", " \t\n"])]
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in simhash.simhash_components(docs_of(spark, rows)).collect()}
    fps = {i: plain_fingerprint(t) for i, t, _ in rows}
    labels = plain_components(fps)
    first = {}
    for i in sorted(fps):
        first.setdefault(labels[i], i)
    assert got == {i: (f"{fps[i]:016x}", first[labels[i]]) for i in fps}


def test_links_in_small_and_large_groups(spark):
    rng = np.random.default_rng(5)
    found = []
    for b in rng.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(int(rng.integers(1, 80))):
            x = int(b)
            for j in rng.choice(64 if rng.random() < 0.5 else 12, int(rng.integers(0, 4)), replace=False):
                x ^= 1 << int(j)
            found.append(x)
    fps = np.unique(np.array(found, dtype=np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {}
    for r in components.connected_components(simhash.near_links(df)).collect():
        got.setdefault(r["root"], set()).add(r["v"])
    want = {}
    for x, label in plain_components({int(x): x for x in fps}).items():
        want.setdefault(label, set()).add(int(np.uint64(x).view(np.int64)))
    assert {frozenset(c) for c in got.values()} == {frozenset(c) for c in want.values() if len(c) > 1}
    assert all(root == min(c) for root, c in got.items())


def test_pigeonring_passes_every_link_and_prunes():
    rng = np.random.default_rng(2)
    near = np.array([(1 << int(a)) | (1 << int(b)) for a, b in rng.integers(0, 64, (500, 2))], dtype=np.uint64)
    assert simhash.chain_within_budget(near).all() and simhash.chain_within_budget(np.zeros(1, np.uint64)).all()
    assert simhash.chain_within_budget(rng.integers(0, 2**63, 5000, dtype=np.uint64)).mean() < 0.01


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_components_of_long_paths_and_stars(spark, monkeypatch, broadcast):
    monkeypatch.setattr(components, "BROADCAST_ROWS", broadcast)
    r = random.Random(1)
    names = r.sample(range(10**6), 120)
    path = list(zip(names[:60], names[1:60], strict=False))
    star = [(names[70], x) for x in names[71:110]]
    got = {x["v"]: x["root"] for x in components.connected_components(spark.createDataFrame(path + star + path[:5] + [(names[115], names[115])], "a long, b long")).collect()}
    assert got == {x: min(names[:60]) for x in names[:60]} | {x: min(names[70:110]) for x in names[70:110]}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_near_copies(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(3, text, "s"), (9, text + " w1", "s"), (4, "another thing entirely here", "s"), (None, text, "s"), (5, None, "s"), (6, "", "s")]
    kept = simhash.drop_near_copies(docs_of(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5] and kept.columns == docs_of(spark, []).columns
    assert simhash.drop_near_copies(docs_of(spark, [])).count() == 0


def plain_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Clamp and reshare until nobody is above; exact arithmetic."""
    from fractions import Fraction

    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    w = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, fixed = Fraction(sum(sizes.values())), {}
    while True:
        rest = total - sum(fixed.values())
        open_ = [s for s in order if s not in fixed]
        level = rest / sum(w[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * w[s] > epochs * sizes[s]]
        if not over:
            return {s: float(fixed[s]) if s in fixed else float(level * w[s]) for s in order}
        fixed |= {s: Fraction(epochs * sizes[s]) for s in over}


def mixing_rows():
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randint(0, 60)), r.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(3000)]
    return rows + [(5000, "tiny source", "q"), (5001, None, "empty"), (None, "w w w", "a")]


def test_mixing_targets_and_sums(spark):
    rows = mixing_rows()
    got = mixing.mix(docs_of(spark, rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    targets = plain_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), {s: max(len(WORDS.findall(t or "")) for _, t, x in rows if x == s) for s in sizes}
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix(docs_of(spark, rows).repartition(7)).collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(again) == key(got)
    assert key(mixing.mix(docs_of(spark, rows), seed=1).collect()) != key(got)


def test_mixed_documents_follow_the_plan(spark):
    rows = mixing_rows()
    plan = {(r["doc_id"]): r["repetitions"] for r in mixing.mix(docs_of(spark, rows)).collect()}
    mixed = mixing.mixed_documents(docs_of(spark, rows))
    counts = {}
    for r in mixed.select("doc_id").collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {k: v for k, v in plan.items() if v} and mixed.columns == docs_of(spark, []).columns
    assert mixing.mix(docs_of(spark, [])).count() == 0 and mixing.mixed_documents(docs_of(spark, [])).count() == 0


def test_mixing_of_one_hot_source(spark):
    rows = [(i, "w " * 10, "hot") for i in range(4000)] + [(9000 + i, "w " * 10, f"s{i % 5}") for i in range(100)]
    got = mixing.mix(docs_of(spark, rows)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 5 for r in got)


def neighbours(spark, vectors, is_query="vec_id % 5 = 0", **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, score string").repartition(3)
    return ann.nearest_neighbours(df, F.expr(is_query), **options).collect()


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [3.0, 0.0]), (None, [1.0, 0.0]), (10, [-1.0, 0.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(neighbours(spark, vectors), key=lambda r: (r["query_id"], r["rank"]))]
    assert got == [(0, 1, 1), (0, 2, 9), (0, 3, 2), (0, 4, 10), (10, 1, 2), (10, 2, 0), (10, 3, 1), (10, 4, 9)]
    assert neighbours(spark, [(0, [1.0])]) == [] and neighbours(spark, [(0, None)]) == []
    assert neighbours(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_neighbours_recall_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERIES_AT_ONCE", 7)
    monkeypatch.setattr(ann, "ROWS_AT_ONCE", 5)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 16)).astype(np.float32)
    x[500:1100] = x[500]  # a third of all rows are one vector
    got = {}
    for r in neighbours(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id % 10 = 0"):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 2000, 10):
        s = unit @ unit[q]
        s[q] = -9
        want = np.lexsort((np.arange(2000), -np.round(s, 12)))[:5]
        own = [v for _, v, _ in sorted(got[q])]
        hits += len(set(want) & set(own))
        assert all(abs(score - s[v]) < 1e-12 for _, v, score in got[q])
        if 500 <= q < 1100:
            assert own == [v for v in range(500, 507) if v != q][:5]
    assert hits / 1000 >= 0.9


def test_neighbours_score_few_rows_of_clusters(spark):
    from phraseloom.llm import forest

    rng = np.random.default_rng(3)
    x = (rng.standard_normal((60, 64))[rng.integers(0, 60, 6000)] + 0.05 * rng.standard_normal((6000, 64))).astype(np.float32)
    found = neighbours(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id % 50 = 0")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    best = {q: set(np.argsort(-np.where(np.arange(6000) == q, -9, unit @ unit[q]))[:5]) for q in range(0, 6000, 50)}
    assert sum(r["vec_id"] in best[r["query_id"]] for r in found) >= 0.9 * 5 * len(best)
    # the queue alone: neighbours that are near close the search after a fifth of the rows
    own = forest.build(unit.astype(np.float32), ann.TREES, 6000 // ann.LEAVES, ann.SEED)
    places = forest.place(own, unit.astype(np.float32))
    opened = 0
    for q in best:
        near = np.sort(unit @ unit[q])[-6]
        leaves = forest.probe(own, unit[q].astype(np.float32), ann.SHARE, ann.REACH * (2 - 2 * near) / 64)
        opened += np.isin(places, leaves).any(axis=1).sum()
    assert opened < 0.2 * 6000 * len(best)


def test_neighbours_of_repeated_ids(spark):
    vectors = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.1]), (6, [1.0, 0.1]), (7, [0.0, 2.0]), (10, [1.0, 0.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(neighbours(spark, vectors), key=lambda r: (r["query_id"], r["rank"]))]
    assert got == [(5, 1, 7), (5, 2, 6), (5, 3, 6), (5, 4, 10), (10, 1, 5), (10, 2, 5), (10, 3, 6), (10, 4, 6), (10, 5, 5)]


def labelled(spark, n=600, seed=2):
    r = random.Random(seed)
    good = ["harbor", "willow", "candle", "meadow", "stone", "river", "gentle", "morning", "quiet", "walk", "the", "of", "and", "in"]
    bad = ["***win***", "$$$", "CLICK!!", "FREE!!", "%%%", "###", "|", "BUY!!"]
    rows, labels = [], []
    for i in range(n):
        y = int(r.random() < 0.7)
        t = int(r.random() < 0.3)
        words = [r.choice(good if y else bad + good[:3]) for _ in range(r.randint(20, 400))]
        for _ in range(3 * t):
            words.insert(r.randint(0, len(words)), r.choice(["idiot", "moron", "scumbag", "scumheads"]))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, y, t))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    df = docs_of(spark, rows + [(9000, None, "s"), (9001, "", "s"), (None, "the quiet river", "s"), (9002, "é" * 100000, "s")])
    model = quality.train(df, labels)
    got = {r["doc_id"]: r for r in quality.score(df, model).collect()}
    assert len(got) == len(rows) + 4 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    test = [i for i in truth if held(i)]
    assert all(got[i]["held_out"] == held(i) for i in truth) and not got[None]["held_out"]
    assert np.mean([got[i]["predicted"] == truth[i] for i in test]) > 0.95
    kept = quality.keep_good(df, model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["score"] >= 0.3} and kept.columns == df.columns


def test_quality_ignores_held_out_labels(spark):
    rows, labels = labelled(spark, 200)
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    df = docs_of(spark, rows)
    assert quality.train(df, labels) == quality.train(df, flipped)


def test_classifiers_without_labels(spark):
    df = docs_of(spark, [(1, "a b", "s"), (2, None, "s")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(df, quality.train(df, none)).collect()} == {0.5}
    assert {r["toxic"] for r in toxicity.toxicity(df, toxicity.train(df, none)).collect()} == {False}
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r["score"] > 0.9 for r in quality.score(df, quality.train(df, one)).collect())
    assert quality.score(docs_of(spark, []), quality.train(df, none)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    df = docs_of(spark, rows + [(9000, None, "s"), (9001, "x " * 50000, "s")])
    chain = toxicity.train(df, labels)
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, chain).collect()}
    assert len(got) == len(rows) + 2 and not got[9000]["toxic"]
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    test = [i for i in truth if held(i)]
    assert np.mean([got[i]["toxic"] == bool(truth[i]) for i in test]) > 0.97
    assert toxicity.toxicity(docs_of(spark, []), chain).count() == 0


def test_chain_uses_earlier_probabilities():
    r = np.random.default_rng(0)
    first = (r.random(800) < 0.5).astype(float)
    rows = [np.array([0 if a else 1]) for a in first]
    # the second label follows the first one, which features tell
    models = toxicity.fit_chain(rows, np.column_stack([first, first]), ["a", "b"])
    assert [len(e) for *_, e in models] == [0, 1] and models[1][3][0] > 0.5
    assert math.isfinite(models[1][0])


def test_out_of_fold_predictions_see_no_row_of_their_fold(monkeypatch):
    seen = []
    select = toxicity.select_features
    monkeypatch.setattr(toxicity, "select_features", lambda rows, y, names: seen.append(len(rows)) or select(rows, y, names))
    r = np.random.default_rng(1)
    y = (r.random(80) < 0.5).astype(float)
    toxicity.fit_chain([np.array([int(a)]) for a in y], np.column_stack([y, y * (r.random(80) < 0.5)]), ["a", "b"])
    assert seen == [60, 60, 60, 60, 80, 80]  # features of a fold's predictions come from the other folds, those of the models from all


def test_toxicity_scores_against_plain_sums(spark):
    r = random.Random(6)
    words = ["idiot", "idiotic", "stone", "river", "Trash", "trashy", "ab", "été"]
    features = tuple(sorted({n for w in words[:6] for n in toxicity.names_of(w.lower())}))
    weights = tuple(tuple(r.uniform(-1, 1) for _ in features) for _ in toxicity.CATEGORIES)
    chain = toxicity.Chain(features, (0.1, -0.2, 0.3), weights, ((), (0.7,), (-0.4, 0.9)))
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 9))) for _ in range(60)] + [None, "", "idiot " * 40_000]
    ids = [*range(60), None, 7, 7]  # null and repeated ids are rows like any other
    df = spark.createDataFrame([(i, t, 0.5, True) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, p_toxic double, toxic boolean")
    found = sorted(((-1 if x["doc_id"] is None else x["doc_id"]), *[round(x[f"p_{c}"], 9) for c in toxicity.CATEGORIES], x["toxic"]) for x in toxicity.toxicity(df, chain).collect())
    want = []
    for i, t in zip(ids, texts, strict=True):
        own, p = {n for w in (t or "").lower().split() for n in toxicity.names_of(w)}, []
        for c in range(3):
            z = chain.bias[c] + sum(w for n, w in zip(features, weights[c], strict=True) if n in own) + sum(e * x for e, x in zip(chain.earlier[c], p, strict=True))
            p.append(1 / (1 + math.exp(-z)))
        want.append((-1 if i is None else i, *[round(x, 9) for x in p], p[0] >= 0.5))
    assert found == sorted(want)


def test_repeated_ids_keep_the_bounds_of_a_fit(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_DOCS", 20)
    monkeypatch.setattr(toxicity, "OTHER_DOCS", 30)
    rows, labels = labelled(spark, 200)
    gathered = []
    fit = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda sets, targets, names: gathered.append(targets.sum(axis=0)[0]) or gathered.append(len(sets)) or fit(sets, targets, names))
    toxicity.train(docs_of(spark, rows * 4), labels.unionByName(labels))
    assert gathered == [20, 50]
    monkeypatch.setattr(quality, "DICT_CHUNKS", 40)
    taken = []
    dictionary = quality._dictionary
    monkeypatch.setattr(quality, "_dictionary", lambda samples: taken.append(len(samples)) or dictionary(samples))
    quality.train(docs_of(spark, rows * 4), labels.unionByName(labels))
    assert taken == [40, 40]


def test_simhash_of_odd_rows(spark):
    texts = ["a b c d e f g", "A B c d e f g", None, "", "one", "one", "w " * 60_000]
    df = docs_of(spark, [(i, t, "s") for i, t in zip([5, 5, None, 2, None, 3, 9], texts, strict=True)])
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.simhash_components(df).collect())
    assert got == [("2", 2), ("3", 3), ("5", 5), ("5", 5), ("9", 9), ("None", 2), ("None", 3)]
    assert simhash.simhash_components(docs_of(spark, [])).count() == 0


def test_simhash_large_groups_pass_the_chain_test(monkeypatch):
    r = np.random.default_rng(2)
    base = int(r.integers(0, 1 << 62))
    fps = np.unique(np.array([base ^ (int(x) << 8) for x in r.integers(0, 1 << 16, 900)], np.uint64))
    tested = []
    near = simhash._near
    monkeypatch.setattr(simhash, "_near", lambda a, b: tested.append(len(a)) or near(a, b))
    a, b = simhash._link_large(fps, 0xFFFF << 8)
    assert sum(tested) >= len(a) and (np.bitwise_count(a ^ b) <= 2).all()  # real links, each through the filter
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def parts(pairs):
        for f in fps:
            root[int(f)] = int(f)
        for x, y in pairs:
            p, q = find(int(x)), find(int(y))
            root[max(p, q)] = min(p, q)
        return [find(int(f)) for f in fps]

    every = [(x, y) for i, x in enumerate(fps) for y in fps[:i][np.bitwise_count(fps[:i] ^ x) <= 2]]
    assert parts(zip(a, b, strict=True)) == parts(every)


def test_pipeline_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.run(spark, sf)
    assert last.count() == sizes[-1] and last.where("not restored").count() == 0


#: Names that the operators use themselves.
OWN_NAMES = ("__key", "__size", "__place", "__cell", "__times", "__again", "__plan_source", "__len", "__prefix", "__sha", "place", "len", "prefix", "gone", "twice", "sha", "key", "id", "fp", "root", "c0", "c1", "row", "Text2")


@pytest.mark.parametrize("operator", ["exact", "near", "simhash", "mixing", "quality"])
def test_columns_of_any_name_pass_unchanged(spark, operator):
    from phraseloom.llm import similar

    rows = [(i, f"w{i} x{i * 7} some words of text {i}", "a", *[f"{n}-{i}" for n in OWN_NAMES]) for i in range(12)] + [(20, "w1 x7 some words of text 1", "b", *[f"{n}-20" for n in OWN_NAMES])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in OWN_NAMES)).repartition(3)
    run = {"exact": exact_dedup.drop_exact_copies, "near": similar.drop_similar, "simhash": simhash.drop_near_copies, "mixing": mixing.mixed_documents, "quality": lambda d: quality.keep_good(d, quality.train(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")))}
    out = run[operator](docs)
    assert out.columns == docs.columns
    given = {r[0]: tuple(r) for r in rows}
    got = [tuple(r) for r in out.collect()]
    assert got and all(given[r[0]] == r for r in got)
