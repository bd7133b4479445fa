"""Token counts of whole texts and of every prefix (see byte_bpe.PrefixCounter for the dynamic programme)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import cutting

LIMIT = 1024
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_chars long"
#: Columns that keep the counts of all prefixes: as they are, or packed (see pack).
STORES = {"array": "prefix_tokens array<int>", "packed": "prefix_packed binary"}


def pack(counts: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Counts from that of no characters on, as differences of 1, 2 or 4 bytes (the first byte says which), packed with zstandard."""
    steps = np.diff(counts)
    low, high = (int(steps.min()), int(steps.max())) if len(steps) else (0, 0)
    width = next(w for w in (1, 2, 4) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + packer.compress(steps.astype(f"<i{width}"))


def unpack(packed: bytes) -> np.ndarray:
    """The counts that ``pack`` has packed."""
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), f"<i{packed[0]}")
    return np.concatenate([[0], np.cumsum(steps)]).astype(np.int32)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, store: bool | str = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), limit_chars.

    ``limit_chars`` is the truncation point: the characters of the longest prefix with at most ``limit`` tokens. With ``store``
    one more column keeps the counts of every prefix, from that of no characters to that of all: "array" (or True)
    as ``prefix_tokens``, from which tokens_before and chars_within answer any truncation or budget question without
    encoding; "packed" as ``prefix_packed``, a fraction of a byte for each prefix, which ``unpacked`` turns into that array.
    An empty or null text has no bytes and no tokens. Special strings in a text count as the library's default does. Counts
    don't depend on other rows: each text is read once, by any task, in bounded batches. Rows that repeat an id, and null
    ids, are rows like any other.
    """
    kind = "array" if store is True else store
    schema = f"{SCHEMA}, {STORES[kind]}" if kind else SCHEMA

    def count(batches):
        from phraseloom.llm import byte_bpe

        counter = byte_bpe.prefix_counter(tokenizer)
        packer = zstandard.ZstdCompressor(level=1)
        for batch in C.small_batches(batches, "text", cutting.AT_ONCE):
            tables = counter.prefix_counts_of(batch.column("text"))
            n = [int(t[-1]) for t in tables]
            cut = [len(t) - 1 if k <= limit else int(np.flatnonzero(t <= limit)[-1]) for t, k in zip(tables, n, strict=True)]
            sizes = np.diff(cutting.bytes_of(batch.column("text"))[1])
            arrays = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_()), pa.array(cut, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars"]
            if kind == "array":
                ends = np.cumsum([0, *map(len, tables)], dtype=np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *tables]))))
            elif kind:
                arrays.append(pa.array([pack(t, packer) for t in tables], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=names + ([STORES[kind].split()[0]] if kind else []))

    return C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), count, schema, "byte_bpe.prefix_counter")


def unpacked(counted: DataFrame) -> DataFrame:
    """A table of packed counts with ``prefix_tokens`` in the place of ``prefix_packed``."""
    names = [c for c in counted.columns if c != "prefix_packed"]

    def run(batches):
        for batch in C.small_batches(batches, "prefix_packed", 1 << 17):
            tables = [unpack(x) for x in batch.column("prefix_packed").to_pylist()]
            ends = np.cumsum([0, *map(len, tables)], dtype=np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *tables])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], prefix], names=[*names, "prefix_tokens"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in counted.select(*names).schema]
    return C.map_arrow(counted.select(*names, "prefix_packed"), run, ", ".join([*fields, STORES["array"]]))


def tokens_before(chars, counts="prefix_tokens"):
    """Column: tokens of the first ``chars`` characters (of all, if there are fewer)."""
    return F.element_at(F.col(counts), F.least(F.greatest(chars, F.lit(0)) + 1, F.size(counts)).cast("int"))


def chars_within(budget, counts="prefix_tokens"):
    """Column: characters of the longest prefix of at most ``budget`` tokens."""
    places = F.filter(F.sequence(F.lit(1), F.size(counts)), lambda i: F.element_at(F.col(counts), i) <= budget)
    return F.coalesce(F.try_element_at(places, F.lit(-1)), F.lit(1)) - 1
