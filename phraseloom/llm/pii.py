"""Personal data: base patterns with exact offsets, and bootstrapped contextual extraction. DataFrame functions only.

Base spans seed the bootstrap, and so do long random strings (kind ``secret``). The words and signs on either side of a seed are
its lexical patterns; patterns and instances score each other in rounds over their bipartite graph; patterns of
high confidence then mark identifiers of the kind's looser shape that no base pattern matches. A secret is never known by its
shape alone: even a seed is reported only beside a confident pattern. The texts are read once: what follows works on a
narrow table of mentions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone")
#: Each pattern finds the leftmost non-overlapping matches of its contract form. Runs are possessive and matches start only where
#: a run starts (or right after the match before), which changes no match and keeps long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a kind can't occur.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: Kinds that the bootstrap may add: the base kinds and strings that look like keys.
ADDED = (*KINDS, "secret")
#: Looser shapes of identifiers: numbers in groups (at most 42 characters), addresses with a written-out or bare at,
#: colon-separated hex groups, and runs of 16 or more letters and digits mixed.
LOOSE = r"(?<![0-9A-Za-z@.])[+(]?[0-9][0-9().\x20/-]{5,40}[0-9](?![0-9A-Za-z@])|(?<!\S)[A-Za-z0-9._%+-]++(?:@|\[at\]|\(at\))[A-Za-z0-9.-]++|(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])|(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+"
#: A seed of a secret: so many characters, digits and letters at least.
SECRET = (32, 8, 6)
#: Pieces of a context: runs of word characters or of signs. A left pattern has up to three, a right one up to two.
TOKEN = r"[\p{L}\p{N}_]++|[^\p{L}\p{N}_\s]++"
LEFT, RIGHT = 3, 2
#: A piece longer than this stands in a pattern by its digest.
LONG_TOKEN = 64
#: Hits of a text whose places are added up in one go.
HITS_AT_ONCE = 128
ROUNDS = 3
#: A pattern counts once so many distinct seeds support it and this share of all instances behind it are of its kind.
SUPPORT = 5
CONFIDENCE = 0.8
#: Weight of an unseen instance of fitting shape in a pattern's denominator until its own score is higher.
UNKNOWN = 0.5
BROADCAST_ROWS = 200_000


def _with_kind(kind: str, f):
    """A one-argument lambda for a higher-order function (those count a lambda's parameters)."""
    return lambda s: f(s, kind)


def _spans(hits: Column, gaps: Column) -> Column:
    """Hits with code-point offsets and the contexts on both sides, from the texts of matches and gaps in turn.

    Offsets are running sums, taken within blocks of hits and then over the blocks, so that a text of many hits costs little more than
    in proportion.
    """
    width = F.size(hits)
    trio = F.arrays_zip(F.slice(gaps, 1, width).alias("gap"), hits.alias("hit"), F.slice(gaps, 2, width).alias("after"))
    row = "struct<start:int,end:int,hit:string,before:string,after:string>"
    empty = F.expr(f"cast(array() as array<{row}>)")

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"), _nearest(F.reverse(x["gap"]), LEFT).alias("before"), _nearest(x["after"], RIGHT).alias("after"))
        return F.struct(end.alias("pos"), F.concat(acc["found"], F.array(one)).alias("found"))

    def block(k):
        return F.aggregate(F.slice(trio, k * HITS_AT_ONCE + 1, F.lit(HITS_AT_ONCE)), F.struct(F.lit(0).alias("pos"), empty.alias("found")), step)

    def chain(acc, x):
        own = F.struct(acc["pos"].alias("at"), x["found"].alias("found"))
        return F.struct((acc["pos"] + x["pos"]).alias("pos"), F.concat(acc["blocks"], F.array(own)).alias("blocks"))

    none = F.expr(f"cast(array() as array<struct<at:int,found:array<{row}>>>)")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((width - 1) / HITS_AT_ONCE).cast("int")), block)
    placed = F.aggregate(blocks, F.struct(F.lit(0).alias("pos"), none.alias("blocks")), chain)["blocks"]
    moved = F.transform(placed, lambda b: F.transform(b["found"], lambda s: F.struct((s["start"] + b["at"]).alias("start"), (s["end"] + b["at"]).alias("end"), s["hit"].alias("hit"), s["before"].alias("before"), s["after"].alias("after"))))
    return F.when(width > 0, F.flatten(moved)).otherwise(empty)


def _nearest(side: Column, pieces: int) -> Column:
    """The first few pieces of what follows a mention, or, of the text before it reversed, of what precedes it."""
    return F.regexp_extract(side, rf"^(?:\s*+(?:{TOKEN})){{0,{pieces}}}", 0)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    n = F.length(_digits(hit))
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), _luhn(_digits(hit))).otherwise(False)
    return n.between(9, 15)


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: doc_id, row_key (hash of id and text), base and loose spans with the contexts on both sides."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.expr("array()").cast("array<string>")
    hits = {}
    for kind, pattern in BASE.items():
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        hits[f"hits_{kind}"] = F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found
    hits["hits_loose"] = F.regexp_extract_all(text, F.lit(LOOSE), F.lit(0))
    rows = rows.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("string"), text).alias("row_key"), *[c.alias(n) for n, c in hits.items()])
    patterns = BASE | {"loose": LOOSE}
    # texts without a hit, nearly all, are not split
    spans = [_spans(F.col(f"hits_{k}"), F.when(F.size(f"hits_{k}") > 0, F.split(text, p, -1)).otherwise(none)).alias(f"all_{k}") for k, p in patterns.items()]
    rows = rows.select("doc_id", "row_key", *spans)
    kept = [F.filter(f"all_{k}", _with_kind(k, lambda s, kind: _valid(kind, s["hit"]))).alias(k) for k in KINDS]
    return rows.select("doc_id", "row_key", *kept, F.col("all_loose").alias("loose"))


def _contexts(span: Column) -> Column:
    """Lexical patterns: the last one to three pieces before a mention and the first one or two after it; lower case, digits as 0."""

    def pieces(side):
        found = F.regexp_extract_all(F.regexp_replace(F.lower(side), "[0-9]", "0"), F.lit(TOKEN), F.lit(0))
        return F.transform(found, lambda t: F.when(F.length(t) > LONG_TOKEN, F.sha2(t, 256)).otherwise(t))

    before, after = pieces(F.reverse(span["before"])), pieces(span["after"])
    left = [F.when(F.size(before) >= n, F.concat(F.array_join(F.slice(before, -n, n), " "), F.lit(" _"))) for n in range(LEFT, 0, -1)]
    right = [F.when(F.size(after) >= n, F.concat(F.lit("_ "), F.array_join(F.slice(after, 1, n), " "))) for n in range(RIGHT, 0, -1)]
    return F.array_compact(F.array(*left, *right))


def _count(hit: Column, letters: str) -> Column:
    return F.length(F.regexp_replace(hit, f"[^{letters}]", ""))


def _key_like(hit: Column) -> Column:
    """Only letters, digits and joining signs, 16 or more, with both letters and digits."""
    return F.rlike(hit, F.lit(r"^(?=[A-Za-z_+/-]*[0-9])(?=[0-9_+/-]*[A-Za-z])[A-Za-z0-9_+/-]{16,}$"))


def _secret_seed(hit: Column) -> Column:
    size, digits, letters = SECRET
    return _key_like(hit) & (F.length(hit) >= size) & (_count(hit, "0-9") >= digits) & (_count(hit, "A-Za-z") >= letters)


def _loose_kind(hit: Column) -> Column:
    """The kinds whose looser shape a mention has."""
    n = F.length(_digits(hit))
    has = lambda c: F.contains(hit, F.lit(c))
    mail = has("@") | has("[at]") | has("(at)")
    dotted = F.rlike(hit, F.lit(r"^[0-9]+(?:\.[0-9]+){3,}$"))
    number = ~mail & ~has(":") & ~dotted
    return F.array_compact(F.array(F.when(mail, F.lit("email")), F.when(~mail & (has(":") | dotted), F.lit("ip")), F.when(number & ~_key_like(hit) & n.between(13, 19), F.lit("card")), F.when(number & ~_key_like(hit) & n.between(7, 15), F.lit("phone")), F.when(_key_like(hit), F.lit("secret"))))


def bootstrap(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Added spans (doc_id, row_key, kind, start, end) from the table of mentions.

    Edges join a pattern (the nearest pieces of text on one side) and an instance (the mention's lower-cased text), each counted once however often it occurs, so copies
    of a text add no weight. In a round a pattern's confidence for a kind is the share of its seeds and of the scores gained
    among the instances behind it, given ``support`` distinct seeds; instances of other kinds or shapes count in full against
    it, unseen ones of the kind's looser shape by UNKNOWN at least. An instance that isn't a seed scores 1 - prod(1 - confidence) over its confident
    patterns. After the rounds a mention is added where a confident pattern precedes an instance that scores
    ``confidence`` or more and has the kind's looser shape. Mentions that overlap a base span are left out.
    """
    mention = lambda s, kind, base, shapes: F.struct(kind.alias("kind"), F.lit(base).alias("base"), s["start"].alias("start"), s["end"].alias("end"), F.lower(s["hit"]).alias("instance"), _contexts(s).alias("patterns"), shapes.alias("shapes"))
    base = reduce(lambda a, b: F.concat(a, b), [F.transform(k, _with_kind(k, lambda s, kind: mention(s, F.lit(kind), True, F.array(F.lit(kind))))) for k in KINDS])
    taken = reduce(lambda a, b: F.concat(a, b), [F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS])
    free = F.filter("loose", lambda s: ~F.exists(taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    loose = F.transform(free, lambda s: mention(s, F.when(_secret_seed(s["hit"]), F.lit("secret")), False, _loose_kind(s["hit"])))
    each = C.materialize(found.select("doc_id", "row_key", F.explode(F.concat(base, loose)).alias("m")).select("doc_id", "row_key", "m.*"), "pii-mentions")
    edges = C.materialize(each.select("kind", "instance", "shapes", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance", "shapes").agg(F.max("kind").alias("seed")), "pii-edges")
    sized = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("seed") == k).alias(f"seeds_{k}") for k in ADDED])
    sized = C.materialize(sized.where(F.greatest(*[F.col(f"seeds_{k}") for k in ADDED]) >= support), "pii-patterns")
    open_edges = edges.where("seed is null").select("pattern", "instance", F.explode("shapes").alias("kind"))
    open_edges = C.materialize(C.join_small(open_edges, sized.select("pattern"), "pattern", "left_semi", BROADCAST_ROWS), "pii-open")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"seeds_{k}").alias("seeds")) for k in ADDED]))
    graph = C.materialize(sized.select("pattern", "n", kinds.alias("k")).select("pattern", "n", "k.*").where(F.col("seeds") >= support), "pii-graph")
    scores = open_edges.select("instance", "kind").distinct().withColumn("score", F.lit(0.0))
    confident = None
    for _ in range(rounds):
        # from the second round on only instances behind confident patterns have a score
        scored = open_edges.join(scores, ["instance", "kind"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        sums = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("gained"), F.sum(F.greatest(F.col("score"), F.lit(UNKNOWN))).alias("counted"), F.count(F.lit(1)).alias("unknown"))
        gained, counted, unknown = (F.coalesce(c, F.lit(0.0)) for c in ("gained", "counted", "unknown"))
        value = (F.col("seeds") + gained) / (F.col("n") - unknown + counted)
        confident = C.materialize(graph.join(sums, ["pattern", "kind"], "left").select("pattern", "kind", value.alias("confidence")).where(F.col("confidence") >= confidence), "pii-confident")
        parts = C.join_small(open_edges, confident, ["pattern", "kind"], "inner", BROADCAST_ROWS)
        miss = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        scores = C.materialize(parts.groupBy("instance", "kind").agg((1 - miss).alias("score")), "pii-scores")
    good = C.join_small(open_edges, confident, ["pattern", "kind"], "left_semi", BROADCAST_ROWS).join(scores.where(F.col("score") >= confidence), ["instance", "kind"], "left_semi")
    # a seed that is no base span is certain once a confident pattern stands beside it
    seeds = edges.where("seed = 'secret'").select("pattern", "instance", F.col("seed").alias("kind"))
    good = good.select("pattern", "instance", "kind").unionByName(C.join_small(seeds, confident, ["pattern", "kind"], "left_semi", BROADCAST_ROWS).select("pattern", "instance", "kind"))
    good = C.materialize(good.distinct(), "pii-good")
    open_mentions = each.where("not base").select("doc_id", "row_key", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    added = C.join_small(open_mentions, good, ["pattern", "instance"], "inner", BROADCAST_ROWS)
    # of several kinds the first listed wins
    rank = F.array_position(F.array(*[F.lit(k) for k in ADDED]), F.col("kind"))
    return added.groupBy("doc_id", "row_key", "start", "end").agg(F.min_by("kind", rank).alias("kind"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), n_added, n_spans (all), base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, ordered by kind as listed (added secrets last), then start. ``base_sha256`` digests the base
    spans so joined, ``spans`` lists base and added ones. A null or empty text has none. Rows that repeat id and text get the
    same spans; null ids are kept.
    """
    found = C.materialize(mentions(docs, id_col, text_col), "pii-found")
    added = bootstrap(found, **options).groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("added"))
    added = C.materialize(added, "pii-added")
    rows = C.join_small(found, added, "row_key", "left", BROADCAST_ROWS)
    own = {k: F.transform(k, _with_kind(k, lambda s, kind: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))) for k in KINDS}
    extra = F.coalesce("added", F.expr("array()").cast("array<struct<start:int,end:int,kind:string>>"))
    own["secret"] = F.expr("array()").cast("array<struct<start:int,end:int,kind:string>>")
    every = [F.array_sort(F.concat(own[k], F.filter(extra, _with_kind(k, lambda s, kind: s["kind"] == kind)))) for k in ADDED]
    return rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.size(extra).cast("long").alias("n_added"), F.size(F.concat(*every)).cast("long").alias("n_spans"), F.sha2(_joined(F.concat(*[own[k] for k in KINDS])).cast("binary"), 256).alias("base_sha256"), _joined(F.concat(*every)).alias("spans"))

