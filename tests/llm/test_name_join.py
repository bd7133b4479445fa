"""Edit-distance name join: the walk over two automata and the distributed join against the plain recurrence."""

import random
import zlib

import numpy as np
import pytest

from phraseloom.llm import automata, name_join

CLIENTS = "client_id long, name string, left_name string, p string, n int, distance int"
VENDORS = "vendor_id long, name string, right_name string, q string, times int, block int"


def osa(s, t):
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(t) + 1)] for i in range(len(s) + 1)]
    for i in range(1, len(s) + 1):
        for j in range(1, len(t) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (s[i - 1] != t[j - 1]))
            if i > 1 and j > 1 and s[i - 1] == t[j - 2] and s[i - 2] == t[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def words(draw, alphabet, n, longest):
    return sorted({"".join(draw.choice(alphabet) for _ in range(draw.randrange(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("alphabet", ["ab", "abcd", "aé中𝒳b", "abcdefghijkl"])
@pytest.mark.parametrize("limit", [0, 1, 2])
def test_walk_against_the_recurrence(alphabet, limit):
    draw = random.Random(limit)
    for _ in range(8):
        left, right = [words(draw, alphabet, 30, 9) for _ in range(2)], [words(draw, alphabet, 25, 9) for _ in range(3)]
        pairs = [(i, j) for i in range(2) for j in range(3)]
        built = [[automata.unpacked(automata.packed(automata.build(w))) for w in side] for side in (left, right)]
        got = []
        for pair, xs, ys, distances in automata.walk(*built, np.array(pairs), limit):
            got += [(int(p), left[pairs[p][0]][x], right[pairs[p][1]][y], int(e)) for p, x, y, e in zip(pair, xs, ys, distances)]
        want = [(k, s, t, osa(s, t)) for k, (i, j) in enumerate(pairs) for s in left[i] for t in right[j] if osa(s, t) <= limit]
        assert sorted(got) == sorted(want)


def test_automata_are_minimal_and_number_their_words(monkeypatch):
    names = sorted(a + b for a in ("an", "ben", "cyn") for b in ("son", "ton", "wick"))
    made = automata.build(names)
    # besides the endings: the root, b, c, and one node for a, be and cy, which all lead on by n
    assert len(made.final) == len(automata.build(sorted(("son", "ton", "wick"))).final) + 4 and made.final.sum() == 1
    monkeypatch.setattr(automata, "AT_ONCE", 7)  # the walk is cut into small parts
    found = [(int(x), int(y)) for _, xs, ys, d in automata.walk([made], [made], np.array([[0, 0]]), 0) for x, y in zip(xs, ys)]
    assert sorted(found) == [(i, i) for i in range(len(names))]


def joined(spark, left, right, **options):
    a, b = spark.createDataFrame([(x,) for x in left], "name string").repartition(3), spark.createDataFrame([(x,) for x in right], "other string").repartition(2)
    got = [tuple(r) for r in name_join.join_names(a, b, **options).collect()]
    limit = options.get("limit", 2)
    assert sorted(got) == sorted((s, t, osa(s, t)) for s in {*left} - {None, ""} for t in {*right} - {None, ""} if osa(s, t) <= limit)
    return got


@pytest.mark.parametrize("options", [{}, {"capacity": 3, "partners": 2}, {"limit": 1, "depths": (3, 4), "capacity": 1}])
def test_join_against_brute_force(spark, options):
    draw = random.Random(4)
    left = words(draw, "abc", 120, 8) + ["prefix shared by all " + w for w in words(draw, "abc", 40, 6)] + [None, "", "aa", "aa", "x" * 3000]
    right = words(draw, "abc", 60, 8) + ["prefix shraed by all " + w for w in words(draw, "abc", 20, 6)] + ["", None, "x" * 2999, "b"]
    assert joined(spark, left, right, **options)


def test_empty_sides(spark):
    assert joined(spark, [], ["a"]) == [] and joined(spark, [None], []) == []
    with pytest.raises(ValueError):
        name_join.join_names(spark.createDataFrame([], "name string"), spark.createDataFrame([], "name string"), limit=3)


def test_links_of_misspelt_vendors(spark):
    draw = random.Random(9)
    names = words(draw, "abé 𝒳", 60, 7)
    clients = [(i, draw.choice([*names, None, ""])) for i in range(150)] + [(3, "ab"), (3, "ab"), (None, "ab"), (None, None)]
    vendors = [(i, draw.choice([*names, None, "", "a"])) for i in range(60)] + [(7, "ab"), (7, "ab"), (None, "ab"), (None, None), (99, "")]

    def spelt(key, name):
        h = zlib.crc32(str(key).encode())
        if key is None or name is None or h % 2 or len(name) < 2:
            return name
        at = h % (len(name) - 1)
        return name[:at] + name[at + 1] + name[at] + name[at + 2 :]

    want = {}
    for key, name in vendors:
        for i, other in clients:
            if name and other and osa(other, spelt(key, name)) <= 2:
                want.setdefault((key, osa(other, spelt(key, name))), []).append(i)
    a = spark.createDataFrame([(*r, "l", "p", 1, 2) for r in clients], CLIENTS).repartition(3)
    b = spark.createDataFrame([(*r, "r", "q", 1, 2) for r in vendors], VENDORS).repartition(3)
    got = {(r.vendor_id, r.distance): (r.n_clients, r.first_client_id, r.clients_crc) for r in name_join.name_links(a, b).collect()}
    known = lambda ids: [i for i in ids if i is not None]
    assert got == {k: (len(ids), min(known(ids), default=None), sum(zlib.crc32(str(i).encode()) for i in known(ids))) for k, ids in want.items()}
