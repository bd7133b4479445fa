"""Token counts, token ids, pieces and personal data against the libraries and plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from phraseloom.llm import byte_bpe, huffman, pieces, pii, token_counts, token_ids  # noqa: E402
from phraseloom.llm import common as C  # noqa: E402

BPE, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_tokens string, start string, fp string, component string"
TEXTS = [None, "", " ", "Hello  world\n\n it's 12 apples!", "<|endoftext|> and <|endo", "日本語 text ünï", "a" * 3000, "x y " * 3000, "same", "same", "\U0001f600 'll 've're \t\t end  ", "﻿ 　wide"]
ALPHABET = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "re", "'re", "'s", "'ll", "1", "23", "!", "?!", "<|endoftext|>", "<|endo", "é", "日", "　", "fi", "ing", "\r\n", "\U0001f600", "ß", "'v"]


def docs_of(spark, texts, ids=None):
    """A table whose extra columns have the names of outputs."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "n", "s", "f", "c") for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def random_texts():
    r = random.Random(7)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 9))) for _ in range(400)]


def test_prefix_counts_are_exact(library, random_texts):
    counter = byte_bpe.PrefixCounter(BPE)
    for text in random_texts + [t for t in TEXTS if t and len(t) < 100]:
        assert list(counter.prefix_counts(text)) == [len(library(text[:i])) for i in range(len(text) + 1)], text


def test_fast_pattern_agrees_at_every_code_point(library):
    counter, encoder = byte_bpe.PrefixCounter(BPE), byte_bpe.PieceEncoder(BPE)
    for cp in [*range(0x250), *range(0x2000, 0x2070), 0x20AC, 0x3000]:
        text = f"x {chr(cp)} {chr(cp)}y{chr(cp)}1"
        assert counter.count(text) == len(library(text)), hex(cp)
        assert list(np.frombuffer(encoder.encode([text])[0], "<u2")) == library(text), hex(cp)


def test_cache_turnover_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    counter, encoder = byte_bpe.PrefixCounter(BPE), byte_bpe.PieceEncoder(BPE)
    for text in ["one two three four five six seven", "eight nine one two ten", "one one one"] * 2:
        assert counter.count(text) == len(library(text)) and list(np.frombuffer(encoder.encode([text])[0], "<u2")) == library(text)


def test_token_counts(spark, library):
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs_of(spark, TEXTS), BPE, limit=20, store=True).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        n = len(library(text))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((text or "").encode()), n, n > 20)
        assert len(library((text or "")[: got[i]["limit_chars"]])) <= 20
    assert token_counts.token_counts(docs_of(spark, []), BPE).count() == 0


def test_stored_counts_answer_budgets(spark, library):
    df = token_counts.token_counts(docs_of(spark, ["Hello there, wide world"]), BPE, store=True)
    from pyspark.sql import functions as F

    r = df.select(token_counts.chars_within(F.lit(2)).alias("c"), token_counts.tokens_before(F.lit(11)).alias("t")).first()
    assert r["c"] == len("Hello there") and r["t"] == 2


def test_repeated_ids_and_null_ids(spark):
    df = docs_of(spark, ["a b", "a b", None, "c"], [1, 1, None, None])
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in token_counts.token_counts(df, BPE).collect()) == [("1", 2), ("1", 2), ("None", 0), ("None", 1)]


@pytest.mark.parametrize("n,m", [(1, 5), (2, 7), (500, 3000), (60000, 200000)])
def test_huffman_round_trip(n, m):
    ids = (np.random.default_rng(1).zipf(1.3, m) % n).astype(np.uint32)
    counts = np.bincount(ids, minlength=n)
    lengths = huffman.code_lengths(counts)
    codes = huffman.canonical_codes(lengths)
    assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1 and lengths.max() <= huffman.MAX_BITS
    cost = int((counts * lengths).sum())
    assert cost >= huffman.plain_huffman_cost(counts) and (lengths.max() == huffman.MAX_BITS or cost == huffman.plain_huffman_cost(counts) or n == 1)
    payload, starts = huffman.encode(ids, codes, lengths)
    sizes = np.full(len(starts), huffman.STEP)
    sizes[-1] = (m - 1) % huffman.STEP + 1
    assert (huffman.decode(payload, starts, sizes, *huffman.decode_table(lengths)) == ids).all()


def test_length_limit_is_optimal_on_a_skewed_table():
    counts = np.array([1, 1, 2, 4, 8, 16, 32, 64])
    lengths = huffman.code_lengths(counts, 4)
    from itertools import combinations_with_replacement

    best = min(sum(c * n for c, n in zip(sorted(counts), sorted(ls, reverse=True), strict=True)) for ls in combinations_with_replacement(range(1, 5), 8) if sum(2.0**-n for n in ls) <= 1)
    assert int((counts * lengths).sum()) == best


@pytest.mark.parametrize("block,bucket", [(1 << 16, 1 << 22), (10, 500)])
def test_token_blocks_round_trip(spark, library, monkeypatch, block, bucket):
    monkeypatch.setattr(token_ids, "BLOCK_IDS", block)
    monkeypatch.setattr(token_ids, "BUCKET_IDS", bucket)
    path = C.scratch_path(spark, "test-blocks")
    token_ids.write_token_blocks(docs_of(spark, TEXTS, [3 * i for i in range(len(TEXTS))]), BPE, path)
    got = {r["doc_id"]: r for r in token_ids.read_token_blocks(spark, path).collect()}
    at = 0
    for i, text in enumerate(TEXTS):
        ids = [*library(text), 0]
        r = got[3 * i]
        assert r["ids"] == ids and (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_token_blocks_of_no_and_odd_rows(spark):
    path = C.scratch_path(spark, "test-blocks")
    token_ids.write_token_blocks(docs_of(spark, []), BPE, path)
    assert token_ids.read_token_blocks(spark, path).count() == 0
    path = C.scratch_path(spark, "test-blocks")
    token_ids.write_token_blocks(docs_of(spark, ["b", None, "a", "a"], [5, None, 5, 5]), BPE, path)
    rows = sorted(token_ids.read_token_blocks(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 5, 5, 5] and [r["start"] for r in rows] == [0, 1, 3, 5]


def brute_segmentations(lattice, unit):
    out = []

    def walk(at, total, ids):
        if at == 0:
            out.append((total, ids))
            return
        for start in range(at):
            i = lattice.ids.get(unit[start:at])
            if i is not None:
                walk(start, total + lattice.score[i], (i, *ids))
            elif start == at - 1:
                own = lattice._spelled(unit[start])
                walk(start, total + lattice.floor * len(own), own + ids)

    walk(len(unit), 0.0, ())
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("n", [1, 2, 5])
def test_n_best_against_all_segmentations(n):
    lattice = pieces.PieceLattice(MODEL, n)
    for unit in ["▁the", "▁▁▁ing", "hello", "▁日本é", "▁tioneding", "\n\t"]:
        want = brute_segmentations(lattice, unit)[:n]
        assert [s for s, _ in lattice.n_best(unit, n)] == pytest.approx([s for s, _ in want])


@pytest.mark.parametrize("n", [2, 3, 4])
def test_units_give_the_n_best_of_the_text(n):
    lattice = pieces.PieceLattice(MODEL, n)
    for text in ["the cat sat", "a  b\n\nc", "Is re, tion ouen", " x ", "日本 語", "m². x"]:
        ids, scores = lattice.encode(text)
        assert scores == pytest.approx([s for s, _ in lattice.n_best(lattice.normalize(text), n)])
        assert lattice.decode(ids) == text


def test_encode_and_decode(spark):
    df = pieces.encode_pieces(docs_of(spark, TEXTS), MODEL)
    got = {r["doc_id"]: r for r in df.collect()}
    assert len(got) == len(TEXTS) and all(r["restored"] for r in got.values())
    assert got[0]["n_pieces"] == got[1]["n_pieces"] == 0 and got[0]["score"] == 0
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["scores"] == sorted(r["scores"], reverse=True) for r in got.values())
    back = {r["doc_id"]: r["text"] for r in pieces.decode_pieces(df, MODEL).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert pieces.encode_pieces(docs_of(spark, []), MODEL).count() == 0


@pytest.mark.parametrize("n, ranks", [(1, False), (2, False), (4, False), (3, True)])
def test_every_one_of_the_n_best_has_its_ids(spark, n, ranks):
    """Ids of all N segmentations of whole texts, in the order of their scores, against all segmentations."""
    import pyarrow as pa

    lattice = pieces.PieceLattice(MODEL, n, ranks)
    assert (lattice.score[300] == lattice.model.get_score(300)) == ranks
    for text in ["the cat", "a  b", "日本 é", "in on"]:
        want = brute_segmentations(lattice, lattice.normalize(text))
        found, scores, restored = lattice.n_best_column(pa.array([text]))
        assert restored == [True] and scores[0] == pytest.approx([s for s, _ in want[:n]])
        known = {ids: s for s, ids in want}
        assert len({tuple(x.tolist()) for x in found[0]}) == len(found[0]) == min(n, len(want))
        assert [known[tuple(x.tolist())] for x in found[0]] == pytest.approx(scores[0])
    for r in pieces.encode_pieces(docs_of(spark, TEXTS), MODEL, n, ranks=ranks).collect():
        assert len(r["n_best_ids"]) == len(r["scores"]) and r["n_best_ids"][0] == r["ids"]
        assert all(lattice.decode(x) == (TEXTS[r["doc_id"]] or "") for x in r["n_best_ids"])
        assert r["n_best_crc32"] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in r["n_best_ids"]]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((v - 9 if (v := int(c) * (2 if i % 2 else 1)) > 9 else v) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            fine = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")), "card": lambda d=d: 13 <= len(d) <= 19 and luhn(d), "phone": lambda d=d: 9 <= len(d) <= 15}[kind]()
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_against_plain_patterns(spark):
    r = random.Random(5)
    parts = ["a", "b.c", "@", ".", "com", "-", "+", "1", "23", "4111 1111 1111 1111", "4111111111111111", " ", "(", "255.1.2.3", "é", "\U0001f600", "\n", "%", "_", "1.2.3.4.5", "999", "+1 (269) 555-3296", "x@y.z", "0", "a@b.c_x@y.z"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(1500)] + [None, "", "a" * 50000, "1" * 30000, "1 " * 10000, "+1" * 5000, "x@y.zz " * 200]
    got = {x["doc_id"]: x for x in pii.find_pii(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain_spans(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}


def test_bootstrap_finds_unseen_numbers(spark):
    seeds = [f"please call my office phone: +1 (269) 555-{3000 + i} thanks" for i in range(12)]
    unseen = [f"you can call my office phone: (269) 555-{4000 + i} thanks" for i in range(4)]
    clean = ["order number 123 456 789 arrived", "the year 1999-2003 was odd", "version 4.0 and 3 more"]
    got = {x["doc_id"]: x for x in pii.find_pii(docs_of(spark, seeds + unseen + clean)).collect()}
    assert all(got[i]["n_added"] == 1 and got[i]["spans"] == "phone:30:44" for i in range(12, 16))
    assert all(got[i]["n_added"] == 0 for i in (*range(12), 16, 17, 18))


def test_copies_are_no_evidence(spark):
    same = ["dial this line: +1 (269) 555-3000 now"] * 40 + ["dial this line: (269) 555-4000 now"]
    got = {x["doc_id"]: x for x in pii.find_pii(docs_of(spark, same)).collect()}
    assert got[40]["n_added"] == 0


def test_pii_of_no_rows_and_odd_ids(spark):
    assert pii.find_pii(docs_of(spark, [])).count() == 0
    rows = pii.find_pii(docs_of(spark, ["a@b.cc", "a@b.cc", None], [None, 4, 4])).collect()
    assert sorted((str(r["doc_id"]), r["n_email"]) for r in rows) == [("4", 0), ("4", 1), ("None", 1)]


def test_unscored_instances_keep_their_weight_in_later_rounds(spark):
    """A pattern of five seeds and three unseen instances gains confidence once one of them is known from elsewhere."""
    known = [f"please call my office phone: +1 (269) 555-{3000 + i} thanks" for i in range(12)] + ["please call my office phone: (269) 555-4000 thanks"]
    seeds = [f"ring our desk extension: +1 (269) 555-{5000 + i} thanks" for i in range(5)]
    unseen = [f"ring our desk extension: (269) 555-{4000 + i} thanks" for i in range(3)]
    got = {x["doc_id"]: x["n_added"] for x in pii.find_pii(docs_of(spark, known + seeds + unseen)).collect()}
    assert [got[i] for i in range(18, 21)] == [1, 1, 1]


def test_budgets_inside_one_long_piece(spark, library):
    from pyspark.sql import functions as F

    texts = ["7391" * 500, "=-+*" * 300, "they're  here   <|endoftext|> x", None]
    df = token_counts.token_counts(docs_of(spark, texts), BPE, limit=6, store=True)
    got = {r["doc_id"]: r for r in df.select("*", token_counts.tokens_before(F.lit(9)).alias("t"), token_counts.chars_within(F.lit(5)).alias("c")).collect()}
    for i, text in enumerate(texts):
        want = [len(library((text or "")[:k])) for k in range(len(text or "") + 1)]
        longest = lambda budget: max(k for k, n in enumerate(want) if n <= budget)  # noqa: E731, B023
        assert got[i]["prefix_tokens"] == want
        assert (got[i]["limit_chars"], got[i]["t"], got[i]["c"]) == (longest(6), want[min(9, len(want) - 1)], longest(5))


def test_batches_agree_with_the_library(library):
    import pyarrow as pa

    r = random.Random(11)
    plain = [a for a in ALPHABET if a.isascii() and not a.startswith("<|")] + ["é", "ß", "\xa0", "\x85", "’", "‐", "it's", "we'll", "'d", "42"]
    texts = ["".join(r.choice(plain) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    texts += ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 9))) for _ in range(300)] + [None, "", "w" * 40_000, "a b'c " * 20_000]
    column = pa.array(texts, pa.string())
    counter, encoder = byte_bpe.PrefixCounter(BPE), byte_bpe.PieceEncoder(BPE)
    wanted = [library(t) for t in texts]
    assert [list(x) for x in encoder.encode_column(column, 7)] == [[*w, 7] for w in wanted]
    tables = counter.prefix_counts_of(column)
    assert [int(t[-1]) for t in tables] == list(map(len, wanted)) and [len(t) for t in tables] == [len(t or "") + 1 for t in texts]
    assert all(list(tables[i]) == [len(library(texts[i][:k])) for k in range(len(texts[i]) + 1)] for i in r.sample(range(3300), 400))
    # a slice of a column, as batches are cut, counts alike
    assert [list(t) for t in counter.prefix_counts_of(column.slice(100, 50))] == [list(t) for t in tables[100:150]]


def test_equal_keys_of_short_pieces_are_told_apart(monkeypatch):
    from phraseloom.llm import cutting

    data = np.frombuffer(b"onetwothreeone" + b"x" * 20 + b"two", np.uint8)
    starts = np.array([0, 3, 6, 11, 14, 34])
    for factor in (cutting.MIX, (np.uint64(0), np.uint64(0))):  # without factors every key is equal
        monkeypatch.setattr(cutting, "MIX", factor)
        which, contents = cutting.distinct_pieces(data, starts)
        assert [contents[k] for k in which] == [b"one", b"two", b"three", b"one", b"x" * 20, b"two"] and len(set(contents)) == len(contents)


def test_packed_counts(spark, library):
    df = token_counts.token_counts(docs_of(spark, TEXTS), BPE, store="packed")
    rows = {r["doc_id"]: r for r in token_counts.unpacked(df).collect()}
    same = {r["doc_id"]: r["prefix_tokens"] for r in token_counts.token_counts(docs_of(spark, TEXTS), BPE, store="array").collect()}
    assert {i: r["prefix_tokens"] for i, r in rows.items()} == same and len(rows) == len(TEXTS)
    assert max(len(r["prefix_packed"]) for r in df.collect()) < 3000


@pytest.mark.parametrize("n", [1, 2, 4])
def test_pieces_of_a_column_are_those_of_each_text(n):
    import pyarrow as pa

    r = random.Random(5)
    lattice = pieces.PieceLattice(MODEL, n)
    texts = ["".join(r.choice([*ALPHABET, "_", "▁", "word", "tion"]) for _ in range(r.randint(0, 12))) for _ in range(600)] + [None, "", "same", "same"]
    ids, scores, restored = lattice.encode_column(pa.array(texts, pa.string()))
    for text, own, best, ok in zip(texts, ids, scores, restored, strict=True):
        alone, single = (lattice._alone(text)[:2]) if text else ([], [0.0])
        assert list(own) == list(alone) and best == pytest.approx(single) and ok


def graph(mentions, rounds=pii.ROUNDS, support=pii.SUPPORT, confidence=pii.CONFIDENCE):
    """The bootstrap in plain Python: (pattern, instance, kinds, seed) edges -> added (pattern, instance, kind)."""
    edges = {}
    for pattern, instance, shapes, seed in mentions:
        key = pattern, instance, tuple(shapes)
        edges[key] = max(filter(None, [edges.get(key), seed]), default=None)
    seeds, size, open_ = {}, {}, set()
    for (p, i, shapes), seed in edges.items():
        size[p] = size.get(p, 0) + 1
        if seed:
            seeds[p, seed] = seeds.get((p, seed), 0) + 1
        else:
            open_ |= {(p, i, k) for k in shapes}
    seeds = {k: n for k, n in seeds.items() if n >= support}
    open_ = {e for e in open_ if any(p == e[0] for p, _ in seeds)}
    scores, confident = {}, {}
    for _ in range(rounds):
        confident = {}
        for (p, k), n in seeds.items():
            own = [scores.get((i, k), 0.0) for q, i, kind in open_ if (q, kind) == (p, k)]
            value = (n + sum(own)) / (size[p] - len(own) + sum(max(x, pii.UNKNOWN) for x in own))
            if value >= confidence:
                confident[p, k] = value
        scores = {}
        for p, i, k in open_:
            if (p, k) in confident:
                scores[i, k] = 1 - (1 - scores.get((i, k), 0.0)) * max(1e-9, 1 - confident[p, k])
    added = {(p, i, k) for p, i, k in open_ if (p, k) in confident and scores.get((i, k), 0) >= confidence}
    return added | {(p, i, "secret") for (p, i, _), seed in edges.items() if seed == "secret" and (p, "secret") in confident}


def test_bootstrap_against_plain_graph(spark):
    from pyspark.sql import functions as F

    r = random.Random(4)
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    number = lambda: f"({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
    made = [lambda: "+1 " + number(), number, lambda: f"a{r.randint(0, 99)}@b.com", lambda: f"a{r.randint(0, 99)} (at) b.com"[:3] + "@home", lambda: "4111 1111 1111 1111", lambda: hexes(40), lambda: "k9" + hexes(16), lambda: "1.2.3.4"]
    lead = {0: ["call", "ring", "dial"], 1: ["order no"] * 6 + ["dial"], 5: ['token = "', "key:", "sha"], 6: ['token = "', "key:", "bag"]}
    texts = []
    for _ in range(400):
        k = r.randrange(len(made))
        texts.append(" ".join([r.choice(["so", "then", "now"]), r.choice(lead.get(k, ["mail", "see", "call"])) + " " + made[k](), r.choice(["thanks", "ok", "today"])]))
    found = C.materialize(pii.mentions(docs_of(spark, texts)), "found")
    got = {(x["doc_id"], x["start"], x["end"], x["kind"]) for x in pii.bootstrap(found).collect()}
    # the same mentions, scored without Spark
    span = lambda s, kind, base, shapes: F.struct(F.lit(base).alias("base"), kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lower(s["hit"]).alias("hit"), pii._contexts(s).alias("patterns"), shapes.alias("shapes"))
    every = F.concat(*[F.transform(k, pii._with_kind(k, lambda s, kind: span(s, F.lit(kind), True, F.array(F.lit(kind))))) for k in pii.KINDS], F.transform("loose", lambda s: span(s, F.when(pii._secret_seed(s["hit"]), F.lit("secret")), False, pii._loose_kind(s["hit"]))))
    rows = found.select("doc_id", F.explode(every).alias("m")).select("doc_id", "m.*").collect()
    taken = {}
    for x in rows:
        if x["base"]:
            taken.setdefault(x["doc_id"], []).append((x["start"], x["end"]))
    rows = [x for x in rows if x["base"] or not any(a < x["end"] and x["start"] < b for a, b in taken.get(x["doc_id"], []))]
    added = graph([(p, x["hit"], x["shapes"], x["kind"]) for x in rows for p in x["patterns"]])
    want = {}
    for x in rows:
        for p in x["patterns"]:
            for k in pii.ADDED:
                if not x["base"] and (p, x["hit"], k) in added:
                    at = x["doc_id"], x["start"], x["end"]
                    want[at] = min(want.get(at, "zzz"), k, key=lambda n: pii.ADDED.index(n) if n in pii.ADDED else 99)
    assert got == {(*at, k) for at, k in want.items()} and len(got) > 20
    assert {k for *_, k in got} >= {"phone", "secret"}


def test_secrets_need_their_context(spark):
    r = random.Random(8)
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    texts = [f'so {w} token = "{key()}" and {w}' for w in "abcdefgh"] + [f"hash {key()} of a file", 'my token = "abc123def456ghi789" here', "a" * 300_000 + " x@y.zz " + "b" * 300_000]
    got = {x["doc_id"]: x for x in pii.find_pii(docs_of(spark, texts)).collect()}
    assert all(got[i]["spans"] == "secret:14:54" and got[i]["n_added"] == got[i]["n_spans"] == 1 for i in range(8))
    assert got[8]["spans"] == "" and got[9]["spans"] == "secret:12:30" and got[10]["spans"] == "email:300001:300007"


def test_many_hits_of_one_text(spark):
    text = "x " + " ".join(f"a{i}@b.com 10.0.{i % 200}.{i // 200}" for i in range(700))
    got = pii.find_pii(docs_of(spark, [text])).first()
    want = plain_spans(text)
    assert (got["n_email"], got["n_ip"]) == (700, 700) and got["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()


def test_rows_of_one_id_are_split(spark, library, monkeypatch, tmp_path):
    monkeypatch.setattr(token_ids, "BUCKET_IDS", 50)
    monkeypatch.setattr(token_ids, "BLOCK_IDS", 20)
    texts = [f"text number {i} of many" for i in range(90)]
    ids = [None] * 30 + [7] * 30 + list(range(30))
    path = f"{tmp_path.as_uri()}/blocks"
    token_ids.write_token_blocks(docs_of(spark, texts, ids), BPE, path)
    assert len({r["bucket"] for r in spark.read.parquet(f"{path}/blocks").select("bucket").distinct().collect()}) > 10
    got = sorted(token_ids.read_token_blocks(spark, path).collect(), key=lambda r: r["start"])
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order) and len(got) == 90  # nulls first, then ascending ids
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    want = sorted((str(i), [*library(t), 0]) for i, t in zip(ids, texts, strict=True))
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == want
