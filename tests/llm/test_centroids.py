"""Centroid clustering against plain Python: ties, odd vectors, repeated rows, large components, few rows."""

import hashlib
import math

import numpy as np
import pytest

from phraseloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, v string, distance string, n string"


def table_of(spark, rows):
    """Rows (vec_id, embedding); the extra columns have names that the operator uses."""
    return spark.createDataFrame([(i, e, 0, "c", "v", "d", "n") for i, e in rows], SCHEMA).repartition(3)


def plain(rows, dims, k, rounds):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    place = lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(kept, key=place)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in set(at):
            own = [v for (_, v), x in zip(kept, at) if x == j]
            c[j] = [sum(col) // len(own) for col in zip(*own)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), c


def check(spark, rows, dims, k, rounds=3):
    want, c = plain(rows, dims, k, rounds)
    clusters, found = centroids.centroid_clusters(table_of(spark, rows), k, rounds, dims)
    assert found == c
    got = centroids.centroid_report(clusters, found).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    assert {r.inertia for r in got} == {sum(w[2] for w in want)}
    for r in got:
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()


def test_against_plain_python_with_odd_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=4) * draw.choice([0.1, 1, 5])).tolist()) for i in range(150)]
    rows += [(200, None), (201, [1.0] * 3), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, float("nan"), 0.0, 0.0]), (204, [float("inf"), 0.0, 0.0, 0.0]), (205, []), (None, [0.5] * 4), (None, [0.0] * 4), (3, rows[3][1]), (3, rows[3][1])]
    check(spark, rows, 4, 12)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(x, y) for x in (-1, 0, 1) for y in (-1, 0, 1)] * 2)]
    check(spark, rows, 2, 7)  # repeated vectors: some centroids are equal, the later ones stay empty


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i / 256, -2e6 + 3 * i]) for i in range(20)] + [(50 + i, [i / 7, 0.25]) for i in range(20)]
    check(spark, rows, 2, 5)
    clusters, found = centroids.centroid_clusters(table_of(spark, [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 0.0])]), 1, 0, 2)
    assert {r.distance is None for r in clusters.collect() if [r.vec_id, found] != []} == {True, False}
    assert {r.inertia for r in centroids.centroid_report(clusters, found).collect()} == {None}


def test_few_and_no_vectors(spark):
    check(spark, [(1, [0.0, 1.0]), (2, [1.0, 0.0])], 2, 5)
    clusters, found = centroids.centroid_clusters(table_of(spark, [(1, None)]), 5, 2, 2)
    report = centroids.centroid_report(clusters, found)
    assert found == [] and report.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and report.count() == 0


@pytest.mark.parametrize("kind", [np.int64, object])
def test_annulus_finds_what_all_comparisons_find_and_prunes(kind):
    draw = np.random.default_rng(1)
    c = draw.integers(-3000, 3000, (40, 8)) * draw.integers(1, 40, (40, 1))
    x = (c[draw.integers(0, 40, 500)] + draw.integers(-50, 50, (500, 8))).astype(kind)
    number, best, compared = centroids.nearest(x, c.astype(kind))
    all_pairs = ((x[:, None, :] - c.astype(kind)[None]) ** 2).sum(axis=2)
    assert (all_pairs.argmin(axis=1) == number).all() and (all_pairs.min(axis=1) == best).all()
    assert compared < 0.5 * 40 * 500
