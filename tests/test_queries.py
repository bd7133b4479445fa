"""Every query with an oracle against DuckDB on the smallest tables."""

import os

import pytest

from phraseloom import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def clean(row):
    return tuple(round(x, 9) if isinstance(x, float) else str(x) if isinstance(x, (list, dict)) else x for x in row)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted(repr(clean([r[i] for i in at])) for r in found.fetchall())
    assert sorted(repr(clean(r)) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    rows = df.collect()
    assert rows and len(rows[0]) == len(df.columns)


def test_examples_are_whole_texts(spark):
    longest = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("max(length(text))").first()[0]
    assert queries.enriched(spark, DATA).selectExpr("max(length(idiom_in_example))").first()[0] > longest / 2 > 44


def test_near_duplicates_by_hand(spark):
    """The one query without SQL: the cascade and the sequence ratio in plain Python."""
    import re
    from difflib import SequenceMatcher

    key = lambda t: " ".join((t or "").lower().split()).replace("’", "'")
    words = lambda t: set(re.findall(r"[A-Za-z0-9]+(?:'[A-Za-z0-9]+)?", t))
    new, main = (sorted(df.collect(), key=lambda r: r["_pos"]) for df in queries._halves(spark, DATA))
    got = {r["_pos"]: (r["status"], r["matched_meaning"]) for r in queries.QUERIES["q_near_duplicates"](spark, DATA).collect()}
    assert set(got) == {r["_pos"] for r in new}
    of: dict = {}
    for r in main:
        if key(r["idiom"]):
            of.setdefault(key(r["idiom"]), []).append((key(r["meaning"]), r["example"]))
    for r in new:
        idiom, meaning = key(r["idiom"]), key(r["meaning"])
        known = of.get(idiom, [])
        pairs = [m for m, _ in known]
        near = next((m for m in pairs if m and meaning and (m == meaning or len(words(m) & words(meaning)) >= 0.85 * len(words(m) | words(meaning)) or SequenceMatcher(None, meaning, m).ratio() >= 0.92)), "")
        status, matched = got[r["_pos"]]
        if not idiom:
            assert status == "remove_missing_idiom"
        elif meaning in pairs:
            assert status in ("remove_exact_duplicate_of_main", "remove_duplicate_idiom_meaning_of_main")
        elif known and not meaning:
            assert status == "remove_existing_idiom_without_new_meaning"
        elif not known:
            assert status.startswith("keep_new") and not matched
        else:
            assert (status, matched) == ("remove_near_duplicate_meaning_of_main" if near else "keep_new_meaning_for_existing_idiom", near)
