"""Phrase mining: frequent n-grams of dialogue lines with their best example.

An n-gram of k lines consists of trigrams of k lines at least. Words and trigram hashes of good lines are written once. A first pass counts
all trigrams by their 64-bit hash; those of k or more set a bit each in a sketch that goes to all tasks. It has EACH buckets for each of them
within two bounds, so that few others share a set bit. The second pass unfolds only n-grams whose trigrams all have their bit. Hashes
and buckets may collide, so that the bits let too much through and never too little; what comes through is counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phraseloom.functions import lexicon as L
from phraseloom.functions import predicates as P
from phraseloom.functions import scores as S
from phraseloom.functions import text as T
from phraseloom.sources.scratch import scratch_folder

EXAMPLES = 20
#: Buckets of the trigram sketch, powers of two: 2 MB of bits at least, 16 MB at most, and so many for each frequent trigram between these.
SKETCH, LARGEST_SKETCH = 1 << 24, 1 << 27
EACH = 8


def ngrams(tokens: Column, least: int, most: int) -> Column:
    """Array of (n, start, phrase, tokens) for every n-gram (SC36); the start counts from 0."""
    size = F.size(tokens)

    def of(n: int) -> Column:
        starts = F.when(size >= n, F.sequence(F.lit(0), F.greatest(size - n, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: let_slice(i, n))

    def let_slice(i: Column, n: int) -> Column:
        return T.let(F.slice(tokens, i + 1, F.lit(n)), lambda w: F.struct(F.lit(n).alias("n"), i.alias("start"), F.array_join(w, " ").alias("phrase"), w.alias("tokens")))

    return F.concat(*[of(n) for n in range(least, most + 1)])


def good_lines(lines: DataFrame, line_id: str = "line_id", text: str = "text") -> DataFrame:
    """(line_id, line): normalised lines worth mining (FLT19)."""
    rows = T.once(lines.select(F.col(line_id).alias("line_id"), F.col(text).alias("__text")), line=T.norm("__text"))
    return rows.where(P.mining_line("line", clean=True)).select("line_id", "line")


def hashed_tokens(lines: DataFrame, line_id: str = "line_id", text: str = "text") -> DataFrame:
    """(line_id, tokens, hashes): the words of good lines and the 64-bit hash of the trigram at each start."""
    good = T.once(good_lines(lines, line_id, text), tokens=F.regexp_extract_all(F.lower("line"), F.lit(T.WORD), F.lit(0))).where(F.size("tokens") >= 3)
    at = lambda i: F.get("tokens", i)
    hashes = F.transform(F.sequence(F.lit(0), F.size("tokens") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    return T.once(good.select("line_id", "tokens"), hashes=hashes)


def frequent_hashes(hashed: DataFrame, min_count: int) -> DataFrame:
    """(h): the hashes of at least ``min_count`` trigrams. Buckets would fill with rare ones as the input grows."""
    return hashed.select(F.explode("hashes").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).select("h")


def sketch_size(frequent: int) -> int:
    """Buckets for so many frequent hashes."""
    return min(max(SKETCH, 1 << (EACH * frequent - 1).bit_length()), LARGEST_SKETCH) if frequent else SKETCH


def frequent_bits(frequent: DataFrame, size: int = SKETCH) -> DataFrame:
    """One row, one array of longs: bit b is set where one of the hashes h falls into bucket b of ``size``."""
    words = size // 64
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bucket", F.lit(64)).cast("int"))
    buckets = frequent.select(F.pmod("h", F.lit(size)).alias("bucket"))
    rows = buckets.groupBy(F.floor(F.col("bucket") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
    dense = frequent.sparkSession.range(words).withColumnRenamed("id", "word").join(rows, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda r: r["bits"]).alias("bits"))


def unfolded(hashed: DataFrame, least: int = 3, most: int = 5, bits: DataFrame | None = None, size: int = SKETCH) -> DataFrame:
    """(line_id, n, start, phrase, again): n-grams that pass the structural filters and whose trigrams have their bit in ``bits``.

    ``again`` marks repeats within the line. Starts are unfolded first, lengths only where the bits allow them, words are joined last.
    """
    same = lambda n, i: F.exists(F.sequence(F.lit(0), i - 1), lambda j: F.slice("tokens", j + 1, n) == F.slice("tokens", i + 1, n))

    def start(x: Column, i: Column) -> Column:
        repeated = F.array_position("hashes", x) != i + 1
        again = [F.when(repeated, same(n, i)).otherwise(False).alias(f"again_{n}") for n in range(least, most + 1)]
        nexts = [F.get("hashes", i + k).alias(f"h{k}") for k in range(most - 2)]
        return F.struct(i.alias("start"), F.slice("tokens", i + 1, F.lit(most)).alias("words"), *nexts, *again)

    rows = hashed.select("line_id", F.explode(F.transform("hashes", start)).alias("s")).select("line_id", "s.*")
    if bits is not None:
        array = bits.scalar()

        def known(h: str) -> Column:
            bucket = F.pmod(h, F.lit(size))
            return F.call_function("shiftrightunsigned", F.get(array, F.floor(bucket / 64).cast("int")), F.pmod(bucket, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    else:
        known = lambda h: F.lit(True)
    first = ~F.get("words", F.lit(0)).isin(*L.PRONOUNS)  # as the filters below ask; the cheapest of them
    rows = T.once(rows.where(first & known("h0")), lengths=_lengths(least, most, known)).where(F.size("lengths") > 0)
    rows = rows.select("line_id", "start", "words", *[f"again_{n}" for n in range(least, most + 1)], F.explode("lengths").alias("n"))
    rows = rows.select("line_id", "n", "start", F.slice("words", F.lit(1), F.col("n")).alias("tokens"), _chosen("again", least, most).alias("again"))
    rows = rows.withColumn("phrase", F.array_join("tokens", " "))
    spoken = (F.col("n") > 3) | P.spoken_signal(F.col("tokens"))
    return rows.where(P.mining_phrase(F.col("phrase"), F.col("tokens")) & spoken).select("line_id", "n", "start", "phrase", "again")


def _lengths(least: int, most: int, known) -> Column:
    """The lengths that fit in the line and whose trigrams behind the first are known as well."""
    fits, each = F.lit(True), []
    for n in range(3, most + 1):
        fits = fits & (F.size("words") >= n) & (known(f"h{n - 3}") if n > 3 else F.lit(True))
        if n >= least:
            each.append(F.when(fits, F.lit(n)))
    return F.array_compact(F.array(*each))


def _chosen(prefix: str, least: int, most: int) -> Column:
    out = F.col(f"{prefix}_{least}")
    for n in range(least + 1, most + 1):
        out = F.when(F.col("n") == n, F.col(f"{prefix}_{n}")).otherwise(out)
    return out


def occurrences(lines: DataFrame, line_id: str = "line_id", text: str = "text", least: int = 3, most: int = 5) -> DataFrame:
    """(line_id, n, start, phrase, again): all n-grams of three words or more of good lines that pass the structural filters."""
    return unfolded(hashed_tokens(lines, line_id, text), least, most)


def frequent_occurrences(lines: DataFrame, min_count: int, line_id: str = "line_id", text: str = "text", least: int = 3, most: int = 5, size: int | None = None) -> DataFrame:
    """The occurrences that may be frequent, as a written table: n-grams are unfolded once, and no other one is ever shuffled."""
    hashed = _written(hashed_tokens(lines, line_id, text), "mining-hashed")
    frequent = _written(frequent_hashes(hashed, min_count), "mining-frequent")
    size = size or sketch_size(frequent.count())
    return _written(unfolded(hashed, least, most, frequent_bits(frequent, size), size), "mining-occurrences")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mine_phrases(lines: DataFrame, min_count: int = 5, line_id: str = "line_id", text: str = "text", least: int = 3, most: int = 5, size: int | None = None) -> DataFrame:
    """Phrases in at least ``min_count`` lines: phrase, frequency_count, example, token_length, lexical_score (AG24, WN11, WN12).

    A line counts once for a phrase. The example is the best of the first 20 occurrences in (line, n, start) order, the first on
    ties: of frequent phrases each task keeps no more than the first 20 occurrences, and only their lines are looked up and
    normalised once more. Line ids must be unique.
    """
    each = frequent_occurrences(lines, min_count, line_id, text, least, most, size)
    counts = each.groupBy("phrase").agg(F.count_if(~F.col("again")).alias("frequency_count")).where(F.col("frequency_count") >= min_count)
    order = Window.partitionBy("phrase").orderBy("line_id", "n", "start")
    first = each.withColumn("at", F.row_number().over(order)).where(F.col("at") <= EXAMPLES).join(counts, "phrase")
    texts = lines.select(F.col(line_id).alias("line_id"), F.col(text).alias("__text"))
    found = T.once(first.select("phrase", "line_id", "at", "frequency_count").join(texts, "line_id"), line=T.norm("__text"))
    scored = found.withColumn("score", S.example_score("line", F.col("phrase"), (5, 16), (4, 20)))
    best = scored.groupBy("phrase").agg(F.max("frequency_count").alias("frequency_count"), F.max_by("line", F.struct(F.col("score"), -F.col("at"))).alias("example"))
    tokens = F.split("phrase", " ")
    return best.select("phrase", "frequency_count", "example", F.size(tokens).alias("token_length"), S.lexical_score(tokens).alias("lexical_score"))


def ordered_phrases(mined: DataFrame) -> DataFrame:
    """The result order of the mining stage (SL1)."""
    return mined.orderBy(F.desc("frequency_count"), F.desc("lexical_score"), F.desc((F.col("example") != "").cast("int")), "token_length", "phrase")


def phrase_counts(lines: DataFrame, **options) -> DataFrame:
    """(phrase, lines, times, first) of all candidates, summed in each task before the shuffle."""
    place = F.struct("line_id", "n", "start")
    return occurrences(lines, **options).groupBy("phrase").agg(F.count_if(~F.col("again")).alias("lines"), F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))


def top_candidates(lines: DataFrame, n: int = 30, **options) -> DataFrame:
    """The most repeated candidates before the frequency filter (AG25)."""
    counts = phrase_counts(lines, **options).withColumnRenamed("lines", "frequency_count")
    return counts.orderBy(F.desc("frequency_count"), "first").limit(n).select("phrase", "frequency_count")


def mining_statistics(lines: DataFrame, min_count: int = 5, **options) -> DataFrame:
    """One row: lines, good lines, structural passes, candidates, frequent phrases, mean frequency (AG32). Everything about phrases comes from one count of them."""
    frequent = F.when(F.col("lines") >= min_count, F.col("lines"))
    parts = lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(P.mining_line(options.get("text", "text"))).alias("good_lines"))
    passed = phrase_counts(lines, **options).agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("structural_passes"), F.count(F.lit(1)).alias("candidates"), F.count(frequent).alias("frequent_phrases"), F.round(F.coalesce(F.avg(frequent), F.lit(0.0)), 4).alias("mean_frequency")
    )
    one = F.lit(1).alias("k")
    return parts.select("*", one).join(passed.select("*", one), "k").drop("k")


def clean_candidates(candidates: DataFrame, position: str = "_pos") -> DataFrame:
    """Candidates by phrase shape and literalness, exact repeats gone, best row per idiom (FLT23, DD23, SC31)."""
    from phraseloom.operators.dedup import best_row, first_row

    rows = candidates.where(P.candidate_phrase("idiom") & ~P.candidate_too_literal("idiom", "example"))
    rows = first_row(rows, [T.idiom_key("idiom"), T.norm("example")], position)
    return best_row(rows, [T.idiom_key("idiom")], [S.candidate_score().desc(), T.norm("example"), position])


