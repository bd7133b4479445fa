"""Token-id files: canonical length-limited Huffman blocks with bit-offset checkpoints, in ascending id order.

The files are Parquet tables of blocks, so that Spark's commit protocol guards them: each row holds the coded documents of a
run of ids (columns ``bucket, block``: the order; ``payload``; ``starts``: a bit offset for every STEP ids of each document;
``doc_ids``, ``doc_counts``). A table ``codes`` beside them holds the code lengths, one byte for each id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import cutting, huffman

END_ID = 0
#: A block ends after the document with which it reaches so many ids; it holds whole documents.
BLOCK_IDS = 1 << 16
#: Ids of a bucket (one file): about 16 MB of texts.
BUCKET_IDS = 1 << 22
MAX_BUCKETS = 50_000


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, width, ids): the library's ids without added special tokens, then ``end_id``; little-endian, ``width`` bytes each, packed with zstandard.

    A null text counts as empty and yields the end id alone.
    """

    def run(batches):
        from phraseloom.llm import byte_bpe

        encoder = byte_bpe.piece_encoder(tokenizer)
        width = encoder.width
        packer = zstandard.ZstdCompressor(level=1)
        for batch in C.small_batches(batches, "text", 2 * cutting.AT_ONCE):
            ids = encoder.encode_column(batch.column("text"), end_id)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([width] * len(ids), pa.int32()), pa.array([packer.compress(x) for x in ids], pa.binary())], names=["doc_id", "n", "width", "ids"])

    return C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, n long, width int, ids binary", "byte_bpe.piece_encoder")


def id_counts(encoded: DataFrame) -> DataFrame:
    """Global counts (id, n): each task adds its own up first, so that a task passes on one row for each id at most."""

    def run(batches):
        total, unpack = np.zeros(0, dtype=np.int64), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for width, ids in zip(batch.column("width").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                found = np.bincount(np.frombuffer(unpack(ids), f"<u{width}"))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), dtype=np.int64)])
                total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    return C.map_arrow(encoded.select("width", "ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _bounds(encoded: DataFrame) -> tuple[list[int], list[int]]:
    """Bucket edges over doc_id, and into how many parts each bucket is split.

    Bucket 0 holds the null ids, bucket k + 1 those above edge k - 1 up to edge k. Edges come from approximate quantiles of that one
    column; at most MAX_BUCKETS numbers (twice as many with split ids). An id whose rows alone hold more than a bucket's size has a bucket of its own, split by content.
    """
    rows = encoded.agg(F.sum("n").alias("n"), F.count("doc_id").alias("rows")).first()
    if not rows["n"]:
        return [], [1, 1]
    size = BUCKET_IDS * max(1, rows["n"] // (BUCKET_IDS * MAX_BUCKETS))
    buckets = -(-rows["n"] // size)
    edges: set[int] = set()
    if buckets > 1 and rows["rows"]:
        at = [k / buckets for k in range(1, buckets)]
        edges |= set(encoded.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * buckets)).alias("q")).first()["q"])
    # at most one row for each bucket's size
    many = {r["doc_id"]: r["n"] for r in encoded.groupBy("doc_id").agg(F.sum("n").alias("n")).where(F.col("n") > size).collect()}
    for i in many:
        if i is not None:
            edges |= {i, i - 1} if i > -(1 << 63) else {i}
    order = sorted(edges)
    parts = [1] * (len(order) + 2)
    for i, n in many.items():
        parts[0 if i is None else order.index(i) + 1] = -(-n // size)
    return order, parts


def write_token_blocks(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write blocks, codes and bucket offsets under ``path``.

    The vocabulary bounds what reaches the driver (one count for each id). Documents are ordered by id, nulls first; rows that
    repeat an id follow one another in an order that their contents give, so reruns write the same. A bucket is a range of ids, or
    a part of the rows of one id that many rows share; its size does not follow the number of partitions the session has set.
    """
    spark = docs.sparkSession
    encoded = C.materialize(encode_documents(docs, tokenizer, end_id, id_col, text_col), "token-ids", codec="uncompressed")  # packed already
    counts = id_counts(encoded).collect()  # at most one row for each id of the vocabulary
    table = np.zeros(max([r["id"] for r in counts], default=0) + 1, dtype=np.int64)
    for r in counts:
        table[r["id"]] = r["n"]
    lengths = huffman.code_lengths(table)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codes")
    bounds, parts = _bounds(encoded)
    bounds_of = spark.sparkContext.broadcast((np.array(bounds, dtype=np.int64), parts, lengths))

    def code(batches):
        import zlib

        edges, parts, own = bounds_of.value
        first = np.cumsum(parts) - parts
        codes, unpack = huffman.canonical_codes(own), zstandard.ZstdDecompressor().decompress
        for batch in C.small_batches(batches, "ids", 1 << 20):  # a million ids or so: their coding takes 60 bytes each
            ids = batch.column("doc_id").to_pylist()
            raw = [np.frombuffer(unpack(x), f"<u{width}") for width, x in zip(batch.column("width").to_pylist(), batch.column("ids").to_pylist(), strict=True)]
            out, starts = huffman.encode_many(raw, codes, own)
            bucket = [0 if x is None else int(np.searchsorted(edges, x, side="left")) + 1 for x in ids]
            bucket = [int(first[b]) + (zlib.crc32(x) % parts[b] if parts[b] > 1 else 0) for b, x in zip(bucket, out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), batch.column("doc_id"), batch.column("n"), pa.array(out, pa.binary()), pa.array(starts, pa.binary())], names=["bucket", "doc_id", "n", "bits", "starts"])

    def pack(batches):
        state: dict = {"bucket": None}

        def flush():
            payload, starts = b"".join(state["bits"]), np.concatenate(state["starts"]) if state["starts"] else np.zeros(0, "<i8")
            row = {"bucket": [state["bucket"]], "block": [state["block"]], "first_id": [state["first"]], "n_ids": [state["n"]], "doc_ids": [state["ids"]], "doc_counts": [state["counts"]], "starts": [starts.astype("<i8").tobytes()], "payload": [payload]}
            state.update(first=state["first"] + state["n"], block=state["block"] + 1, n=0, at=0, bits=[], starts=[], ids=[], counts=[])
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        arrow = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_counts", pa.list_(pa.int64())), ("starts", pa.binary()), ("payload", pa.binary())])
        for batch in batches:
            for bucket, doc, n, bits, starts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "n", "bits", "starts")), strict=True):
                if bucket != state["bucket"]:
                    if state["bucket"] is not None and state["ids"]:
                        yield flush()
                    state = {"bucket": bucket, "block": 0, "first": 0, "n": 0, "at": 0, "bits": [], "starts": [], "ids": [], "counts": []}
                state["ids"].append(doc)
                state["counts"].append(n)
                state["bits"].append(bits)
                state["starts"].append(np.frombuffer(starts, "<i8") + state["at"] * 8)
                state["at"] += len(bits)
                state["n"] += n
                if state["n"] >= BLOCK_IDS:
                    yield flush()
        if state["bucket"] is not None and state["ids"]:
            yield flush()

    coded = C.map_arrow(encoded, code, "bucket int, doc_id long, n long, bits binary, starts binary")
    ordered = coded.repartitionById(sum(parts), "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "n", "bits")
    blocks = C.map_arrow(ordered, pack, "bucket int, block long, first_id long, n_ids long, doc_ids array<long>, doc_counts array<long>, starts binary, payload binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    C.remove(spark, encoded)
    # one row for each bucket: the ids of all buckets before it
    totals = spark.read.parquet(f"{path}/blocks").groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    totals.select("bucket", before.alias("before")).coalesce(1).write.parquet(f"{path}/offsets")


def read_token_blocks(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a token-block folder: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked, ids.

    ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers. Blocks decode independently;
    documents of one block come from one table-driven pass over all its checkpoints.
    """
    shared = spark.sparkContext.broadcast(bytes(spark.read.parquet(f"{path}/codes").first()["lengths"]))

    def run(batches):
        import zlib

        symbol, bits = huffman.decode_table(np.frombuffer(shared.value, dtype=np.uint8))
        for batch in batches:
            for bucket, first, docs, counts, starts, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "first_id", "doc_ids", "doc_counts", "starts", "payload")), strict=True):
                n = np.array(counts, dtype=np.int64)
                lanes = np.repeat(n, (n + huffman.STEP - 1) // huffman.STEP)
                own = np.full(len(lanes), huffman.STEP, dtype=np.int64)
                last = np.cumsum((n + huffman.STEP - 1) // huffman.STEP) - 1
                own[last[n > 0]] = ((n - 1) % huffman.STEP + 1)[n > 0]
                ids = huffman.decode(payload, np.frombuffer(starts, "<i8"), own, symbol, bits).astype("<u4")
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                parts = [raw[4 * int(e - k) : 4 * int(e)] for e, k in zip(ends, n, strict=True)]
                arrays = [pa.array([bucket] * len(n), pa.int32()), pa.array(docs, pa.int64()), pa.array(first + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["bucket", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in parts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "bucket int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    rows = C.map_arrow(spark.read.parquet(f"{path}/blocks"), run, schema)
    offsets = spark.read.parquet(f"{path}/offsets")  # one row for each bucket, MAX_BUCKETS at most
    out = rows.join(F.broadcast(offsets), "bucket").withColumn("start", F.col("at") + F.col("before"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
