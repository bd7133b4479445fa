"""SetSketch near-duplicates: registers against their definition, estimates, whole results against brute force."""

import random
import re

import numpy as np
import pytest

from phraseloom.llm import setsketch, similar

SCHEMA = "doc_id long, text string, key string, id string, n string, root string, component string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    """Rows (doc_id, text); the extra columns have names that the operator uses."""
    return spark.createDataFrame([(*r, "k", "i", "n", "r", "c") for r in rows], SCHEMA).repartition(3)


def shingles(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {" ".join(w)} if w else set()


def plain(rows):
    """(doc_id, n_shingles, component_id) of all pairs, compared one by one."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str)


def variants(seed, families, size, words, rate):
    draw = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{draw.randrange(4000)}" for _ in range(words)]
        for _ in range(size):
            rows.append((1000 + len(rows), " ".join(f"x{draw.randrange(10**6)}" if draw.random() < rate else w for w in base)))
    draw.shuffle(rows)
    return rows


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two"), (8, "one two three"), (9, "one two three"), (10, "a b c " * 3000), (11, "a b c " * 2999), (None, "null id alone here"), (None, "one two"), (12, "a b c d e f g h i"), (12, "a b c d e f g h i"), (13, "É b c"), (14, "é b c")]


def compared(spark, rows):
    got = setsketch.sketch_components(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    compared(spark, ODD)
    empty = setsketch.sketch_components(docs_of(spark, []))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.count() == 0


@pytest.mark.parametrize(("broadcast", "blocks"), [(500_000, 8192), (0, 7)])
def test_families_around_the_threshold_against_brute_force(spark, monkeypatch, broadcast, blocks):
    monkeypatch.setattr(similar, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(similar.open_pairs, "__defaults__", (blocks,))
    rows = variants(3, 6, 40, 120, 0.02) + [(9000 + i, t) for i, (_, t) in enumerate(variants(4, 40, 3, 30, 0.03))]
    compared(spark, rows)


def test_near_copies_just_below_the_similarity_are_pruned_before_their_sets_meet(spark):
    rows = variants(5, 1, 80, 120, 0.024)
    narrow = spark.createDataFrame([(i, i, t) for i, t in rows], "key long, id long, text string").repartition(3)
    own = setsketch.sketch_table(narrow).select("key", "n", "print", "registers")
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(a, b) for b in sets for a in sets if a < b]
    true = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    left = {tuple(r) for r in setsketch.pruned(spark.createDataFrame(pairs, "a long, b long"), own, setsketch.SIMILARITY).collect()}
    # registers alone leave most of these pairs
    assert true and true <= left and len(left - true) < len(pairs) / 10


def test_blocks_of_a_shingle_give_the_pairs_of_the_whole(spark):
    rows = [(1, key, 100, key % 9, b"\0" * (similar.BITS // 8), 60) for key in range(60)]
    table = spark.createDataFrame(rows, "hash long, key long, n long, root long, print binary, rows long").repartition(4)
    pairs = lambda size: sorted(map(tuple, similar.open_pairs(table, 0.85, size).collect()))
    assert pairs(8) == pairs(1000) == sorted((a, b) for b in range(60) for a in range(b) if a % 9 != b % 9)


def test_registers_are_truncated_minima_that_merge():
    draw = np.random.default_rng(2)
    a, b = (np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64)) for n in (400, 37))
    x, y, both = setsketch.sketches([a, b, np.union1d(a, b)])
    assert (np.maximum(x, y) == both).all()
    # the limit under which points are drawn does not matter, nor what else is in the batch
    whole = setsketch.minima(a, np.zeros(len(a), np.int64), np.array([1]))
    assert (setsketch.registers_of(whole)[0] == x).all()
    assert (setsketch.sketches([a[::-1], np.zeros(0, np.uint64)])[0] == x).all() and not setsketch.sketches([np.zeros(0, np.uint64)]).any()


def test_estimates_follow_the_similarity_and_bands_miss_no_pair():
    draw = np.random.default_rng(8)
    for common, n, m in ((190, 200, 210), (150, 160, 170), (60, 100, 140), (0, 100, 100)):
        a, b = [], []
        for _ in range(60):
            pool = np.unique(draw.integers(0, 1 << 63, n + m).astype(np.uint64))
            a.append(pool[:n])
            b.append(np.concatenate([pool[:common], pool[n : n + m - common]]))
        x, y, sizes = setsketch.sketches(a), setsketch.sketches(b), (np.full(60, n), np.full(60, m))
        true = common / (n + m - common)
        assert abs(setsketch.estimate(x, y, *sizes).mean() - true) < 0.02
        meet = (setsketch.band_hashes(x) == setsketch.band_hashes(y)).any(axis=1)
        may = setsketch.may_reach(x, y, *sizes)
        if true >= 0.85:
            assert meet.all() and may.all()
        if true < 0.5:
            assert not may.any()
    assert (1 - 0.85**setsketch.ROWS) ** setsketch.BANDS < 2e-11
