"""Near copies by shingle similarity against brute force."""

import random

import numpy as np
import pytest

from phraseloom.llm import similar

SCHEMA = "doc_id long, text string, key string, fp string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "f") for r in rows], SCHEMA).repartition(3)


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows, least=0.8):
    own = {i: shingles(t) for i, t in rows}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in own:
        for b in own:
            if a < b:
                union = len(own[a] | own[b])
                if union == 0 or len(own[a] & own[b]) >= least * union:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in own}


def corpus(seed=1, n=120):
    r = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = [r.choice(common) if r.random() < 0.5 else f"w{r.randint(0, 5000)}" for _ in range(r.randint(6, 400))]
        rows.append(words)
        if i % 3 == 0:
            for share in (0.01, 0.02, 0.05, 0.15):
                rows.append([w if r.random() > share else f"n{r.randint(0, 10**6)}" for w in words])
    texts = [" ".join(w) for w in rows] + ["", None, "one two", "ONE two", "a b c d e f"]
    order = list(range(len(texts)))
    r.shuffle(order)
    return [(i, t) for i, t in zip(order, texts, strict=True)]


@pytest.mark.parametrize("small", [48, 3])
def test_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(similar, "SMALL_GROUP", small)
    rows = corpus()
    root = groups(rows)
    kept = {r["doc_id"] for r in similar.drop_similar(docs_of(spark, rows)).collect()}
    want = set(root.values())
    assert want <= kept  # no document is dropped that isn't a near copy of a smaller one
    assert len(kept - want) <= 0.03 * (len(rows) - len(want))  # proposals miss one pair in fifty at most


def test_hot_group_and_shared_passage(spark):
    r = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    hot = [(i, " ".join(w if r.random() > 0.004 else f"n{r.randint(0, 999)}" for w in base)) for i in range(400)]
    passage = " ".join(f"p{i}" for i in range(60))
    other = [(1000 + i, passage + " " + " ".join(f"x{i}_{j}" for j in range(80))) for i in range(100)]
    kept = {x["doc_id"] for x in similar.drop_similar(docs_of(spark, hot + other)).collect()}
    assert {i for i in kept if i >= 1000} == {i for i, _ in other}
    assert 0 in kept and len([i for i in kept if i < 1000]) <= 4


def test_odd_rows(spark):
    df = docs_of(spark, [(None, "same text of six words here"), (7, "same text of six words here"), (8, None), (9, ""), (3, "alone")])
    out = similar.drop_similar(df)
    assert sorted(r["doc_id"] for r in out.collect()) == [3, 7, 8] and out.columns == df.columns
    assert similar.drop_similar(docs_of(spark, [])).count() == 0


def test_pruning_keeps_what_is_near():
    rng = np.random.default_rng(3)
    diff = np.zeros((300, similar.BITS), np.uint8)
    for i, n in enumerate(rng.integers(0, similar.RADIUS + 1, 300)):
        diff[i, rng.choice(similar.BITS, int(n), replace=False)] = 1
    assert similar.within_radius(np.packbits(diff, axis=1)).all()
    far = rng.integers(0, 256, (300, similar.BITS // 8), dtype=np.uint8)
    assert not similar.within_radius(far).any()


def kept_of(spark, texts):
    return {x["doc_id"] for x in similar.drop_similar(docs_of(spark, list(enumerate(texts)))).collect()}


def test_one_vocabulary_in_other_orders(spark):
    """Many documents of one word set lie nearer to a copy's original than the copy: none may displace it."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    orders = [" ".join(r.sample(words, len(words))) for _ in range(40)]
    near = [t + " one two" for t in orders[:12]]
    assert kept_of(spark, orders + near) == set(range(40))


def test_copies_of_variants_of_one_page(spark, monkeypatch):
    """A row near a representative that isn't its copy must still meet its own copy."""
    monkeypatch.setattr(similar, "SMALL_GROUP", 3)
    r = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    pages = [[w if r.random() > 0.03 else f"n{r.randint(0, 10**6)}" for w in base] for _ in range(60)]
    texts = [" ".join(p) for p in pages + [[*p[:-1], "end"] for p in pages]]
    want = set(groups(list(enumerate(texts))).values())
    assert len(want) == 60 and kept_of(spark, texts) == want


@pytest.mark.parametrize("n", [100, 300])
def test_contiguous_edits_against_brute_force(spark, n):
    """Text appended, cut off and one passage replaced, down to similarity 0.8 and just below."""
    texts = []
    for i in range(8):
        words = [f"w{i}_{j}" for j in range(n)]
        new = [f"n{i}_{j}" for j in range(n)]
        at = n // 3
        for share in (0.11, 0.23, 0.27):
            d = int(share * n)
            part = [f"{w}_{share}" for w in words]
            texts += [" ".join(part), " ".join(part + new[:d])]
            cut = [f"{w}c" for w in part]
            texts += [" ".join(cut), " ".join(cut[: int(n / (1 + share))])]
            other = [f"{w}r" for w in part]
            texts += [" ".join(other), " ".join(other[:at] + new[: d // 2 - 2] + other[at + d // 2 - 2 :])]
    want = set(groups(list(enumerate(texts))).values())
    assert len(texts) / 2 < len(want) < len(texts) and kept_of(spark, texts) == want


@pytest.mark.parametrize("share", [0.012, 0.02])
def test_a_cluster_of_variants_against_brute_force(spark, share):
    """600 variants of one text: which of them stay is what all pairs decide, however large the group."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w if r.random() > share else f"n{r.randint(0, 10**6)}" for w in base)) for i in range(600)]
    want = set(groups(rows).values())
    got = {x["doc_id"] for x in similar.drop_similar(docs_of(spark, rows)).collect()}
    assert got == want and 30 < len(want) < 400


def test_wide_parities_bound_the_difference():
    r = random.Random(3)
    for n in (1, 5, 400, 600, 3000):
        a = np.array(r.sample(range(1 << 62), n), np.uint64)
        for change in (0, n // 10, n // 2, n):
            b = np.concatenate([a[change:], np.array(r.sample(range(1 << 62), change + n // 3), np.uint64)])
            bits = similar.differing(similar.wide_parities(np.unique(a)), similar.wide_parities(np.unique(b)))
            assert bits <= len(np.setxor1d(a, b)) and (bits > 0 or len(np.setxor1d(a, b)) < 20 or n < 5)
