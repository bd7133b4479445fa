"""Canonical, length-limited Huffman codes over token ids, with vectorised packing and table-driven decoding.

A document's ids are coded into a byte string of their own; a block joins the strings of consecutive documents and
keeps, for every STEP ids, the bit at which they start. Blocks decode independently, and within a block all checkpoints
are decoded side by side, one table look-up for each id.
"""

from __future__ import annotations

import heapq

import numpy as np

MAX_BITS = 16
STEP = 64


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for ids that don't occur. Ties go to smaller ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit codes of {max_bits} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # each level's list in order of weight: single ids, and packages of two items of the level before
    level_w = weights
    is_single = np.ones(n, dtype=bool)
    stack = []
    for _ in range(max_bits - 1):
        stack.append(is_single)
        packed = level_w[: len(level_w) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, packed])
        rank = np.argsort(merged, kind="stable")
        level_w, is_single = merged[rank], rank < n
    stack.append(is_single)
    take = 2 * n - 2
    for level in reversed(stack):
        singles = int(level[:take].sum())
        lengths[order[:singles]] += 1
        take = 2 * (take - singles)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in canonical order (length, then id)."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    code = previous = 0
    for i in ids:
        code <<= int(lengths[i]) - previous
        previous = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """For every ``max_bits`` window: the id whose code it starts with, and that code's length."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    spans = 1 << (max_bits - lengths[ids].astype(np.int64))
    symbol = np.zeros(1 << max_bits, dtype=np.uint32)
    bits = np.ones(1 << max_bits, dtype=np.uint8)
    filled = np.repeat(ids, spans)
    symbol[: len(filled)] = filled
    bits[: len(filled)] = np.repeat(lengths[ids], spans)
    return symbol, bits


def encode_many(documents: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """For each document its coded bytes and the start bits of every STEP-th id (little-endian 64-bit), all in one pass."""
    counts = np.array([len(d) for d in documents], dtype=np.int64)
    if not counts.sum():
        return [b""] * len(documents), [b""] * len(documents)
    ids = np.concatenate(documents)
    size = lengths.astype(np.int64 if len(ids) > 1 << 26 else np.int32)[ids]  # of so many ids all bits fit 32
    ends = np.cumsum(size, dtype=size.dtype)
    first = np.cumsum(counts) - counts  # of each document: its first id, its bits before, and its bytes before
    upto = np.concatenate([np.zeros(1, size.dtype), ends])
    bits = (upto[first + counts] - upto[first]).astype(np.int64)
    width = (bits + 7) // 8
    byte = np.cumsum(width) - width
    # every document starts at a byte
    starts = ends
    starts -= size
    starts += np.repeat((8 * byte - upto[first]).astype(size.dtype), counts)
    # a code of at most 16 bits, from any bit on, lies within three bytes
    shifted = codes[ids] << (24 - (starts & 7) - size).astype(np.uint32)
    at = starts >> 3
    out = np.zeros(int(width.sum()) + 3, dtype=np.uint8)
    # codes that start in one byte are neighbours and overlap in no bit: their sum is their union
    heads = np.flatnonzero(np.diff(at, prepend=-1))
    joined = np.add.reduceat(shifted, heads)
    at = at[heads]
    for k in range(3):
        out[at + k] |= (joined >> np.uint32(16 - 8 * k)).astype(np.uint8)
    raw = memoryview(out.tobytes())
    local = starts - np.repeat((8 * byte).astype(starts.dtype), counts)
    payloads = [bytes(raw[b : b + w]) for b, w in zip(byte.tolist(), width.tolist(), strict=True)]
    return payloads, [local[f : f + n : STEP].astype("<i8").tobytes() for f, n in zip(first.tolist(), counts.tolist(), strict=True)]


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The coded bytes and the start bit of every STEP-th id of one document."""
    payloads, starts = encode_many([ids], codes, lengths)
    return payloads[0], np.frombuffer(starts[0], "<i8")


def decode(payload: bytes, starts: np.ndarray, counts: np.ndarray, symbol: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Ids of a block: lane k starts at bit ``starts[k]`` and holds ``counts[k]`` ids (at most STEP)."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint32)
    data = np.frombuffer(payload + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    window = (data[:-3] << 16) | (data[1:-2] << 8) | data[2:-1]
    order = np.argsort(-counts, kind="stable")
    live = np.searchsorted(-counts[order], -np.arange(1, int(counts.max()) + 1), side="right")
    at = starts[order].astype(np.int64)
    first = (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), dtype=np.uint32)
    for k, n in enumerate(live):
        own = at[:n]
        key = (window[own >> 3] >> (8 - (own & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[first[:n] + k] = symbol[key]
        at[:n] = own + bits[key]
    return out


def plain_huffman_cost(counts: np.ndarray) -> int:
    """Bits of an unlimited Huffman code, the lower bound that tests compare with."""
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost
