"""The registered queries on whole small tables: against SQL where there is some, else against the libraries or brute force."""

import os
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from phraseloom.llm import queries, simhash  # noqa: E402

from .test_text_operators import plain_spans  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def rows(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "clients", "vendors"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, found.fetchall()))


def test_token_counts(spark, docs, encode):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows(spark, "op1_token_counts")}
    want = {i: (len(t.encode()), len(encode(t))) for i, t in docs.items()}
    assert got == {i: (b, n, n > 1024) for i, (b, n) in want.items()}


def test_token_ids(spark, docs, encode):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows(spark, "op10_token_ids")}
    want, at = {}, 0
    for i in sorted(docs):
        ids = np.array([*encode(docs[i]), 0], "<u4")
        want[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want


def test_pieces(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op2_sentencepiece")}
    assert set(got) == set(docs) and all(r["restored"] for r in got.values())
    assert all((r["n_pieces"] > 0) == bool(docs[i]) and r["scores"] == sorted(r["scores"], reverse=True) for i, r in got.items())


def test_base_spans(spark, docs):
    import hashlib

    got = {r["doc_id"]: r for r in rows(spark, "op5_pii")}
    for i, text in docs.items():
        want = plain_spans(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(filter(None, want)) <= set(got[i]["spans"].split(","))


def test_neighbours(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got: dict = {}
    for r in rows(spark, "op6_ann"):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[q]
        s[q] = -9
        own = got[ids[q]]
        assert sorted(own) == [1, 2, 3, 4, 5]
        assert all(abs(score - s[np.flatnonzero(ids == v)[0]]) < 1e-12 for v, score in own.values())
        hits += len({v for v, _ in own.values()} & set(ids[np.argsort(-s)[:5]]))
    assert hits >= 0.9 * 5 * len(got) and len(got) == (ids % 50 == 0).sum()


def test_simhash(spark, docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op7_simhash")}
    fps = {i: simhash.fingerprint(simhash.hash_shingles(t, 3)) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(docs)
    for k, a in enumerate(order):
        for b in order[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert got == {i: (f"{fps[i]:016x}", find(i)) for i in docs}


@pytest.mark.parametrize("name,score", [("op3_toxicity", "p_toxic"), ("op9_quality", "score")])
def test_scores(spark, docs, name, score):
    got = {r["doc_id"]: r for r in rows(spark, name)}
    assert set(got) == set(docs) and all(0 <= r[score] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
