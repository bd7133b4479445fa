"""Texts of a batch cut into pieces all at once: byte classes, piece boundaries and look-ups by whole arrays.

The batch's bytes are classified through a table of code points, boundaries are comparisons of neighbouring classes, and a
dictionary of the distinct pieces leaves one look-up for each of them. Texts with characters beyond the table are told apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points the tables cover; beyond them only the punctuation of COMMON is known.
COVERED = 0x250
COMMON = ((0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC))
BEYOND = 255
#: Bytes of texts that are cut at once.
AT_ONCE = 4 << 20


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each (one more than texts); null is empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def class_table(of, other: int) -> tuple[np.ndarray, np.ndarray, int]:
    """From ``of`` (character -> class): the classes of single bytes and of covered code points, and that of COMMON."""
    codes = np.array([of(chr(c)) for c in range(COVERED)], np.uint8)
    single = np.zeros(256, np.uint8)
    single[:128] = codes[:128]
    return single, codes, other


def classes(data: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The class of every byte, that of its character; BEYOND on the first byte of an unknown one."""
    single, codes, other = table
    out = single[data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return out
    first = data[lead]
    two = lead[first < 0xCA]
    kind = codes[((data[two] & 0x1F).astype(np.int64) << 6) | (data[two + 1] & 0x3F)]
    out[two] = kind
    out[two + 1] = kind
    rest = lead[first >= 0xCA]
    if len(rest):
        out[rest] = BEYOND
        three = rest[data[rest] == 0xE2]
        code = 0x2000 | (data[three + 1] & 0x3F).astype(np.int64) << 6 | (data[three + 2] & 0x3F)
        fine = three[np.logical_or.reduce([(code >= a) & (code <= b) for a, b in COMMON])]
        for k in range(3):
            out[fine + k] = other
    return out


def beyond(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a character that the table doesn't cover."""
    at = np.flatnonzero(kinds == BEYOND)
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, at, side="right") - 1] = True
    return out


def text_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """A mark on the first byte of every text that has one."""
    out = np.zeros(size, bool)
    out[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return out


#: Multipliers of the two words of a short piece's key: odd, from the golden ratio and the square root of 2.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xB504F333F9DE6485))
SHORT = 16
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _words(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first sixteen bytes of each piece of at most so many as two integers; what lies beyond a piece is zero."""
    padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    every = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))
    return every[at] & _LOW[np.minimum(length, 8)], every[at + 8 * (length > 8)] & _LOW[np.maximum(length - 8, 0)]


def distinct_pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each piece's content, and the distinct contents.

    Short pieces are told apart by a key of 64 bits, which is then held against their bytes; long ones, and short ones if two
    of a batch share a key, by their bytes.
    """
    stops = np.append(starts[1:], len(data))
    length = stops - starts
    short = np.flatnonzero(length <= SHORT)
    which, first = np.empty(len(starts), np.int64), np.zeros(0, np.int64)
    one, two = _words(data, starts[short], length[short])
    key = (one * MIX[0]) ^ (two * MIX[1]) + length[short].astype(np.uint64) * MIX[1]
    coded = pa.array(key ^ key >> np.uint64(29)).dictionary_encode()
    own = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), np.int64)
    first[own[::-1]] = np.arange(len(short))[::-1]
    seen = first[own]
    if ((one == one[seen]) & (two == two[seen]) & (length[short] == length[short[seen]])).all():
        which[short] = own
        first, rest = short[first], np.flatnonzero(length > SHORT)
    else:
        first, rest = first[:0], np.arange(len(starts))
    raw = data.tobytes()
    contents = [raw[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
    if len(rest):
        coded = pa.array([raw[a:b] for a, b in zip(starts[rest].tolist(), stops[rest].tolist(), strict=True)], pa.binary()).dictionary_encode()
        which[rest] = coded.indices.to_numpy().astype(np.int64) + len(contents)
        contents += coded.dictionary.to_pylist()
    return which, contents


def gather(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[first[k] : first[k] + length[k]] for all k, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.repeat((first - ends + length).astype(kind), length)
    at += np.arange(total, dtype=kind)
    return flat[at]


def without(data: np.ndarray, offsets: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with those marked in ``gone`` emptied."""
    length = np.diff(offsets)
    left = data[~np.repeat(gone, length)]
    return left, np.concatenate([[0], np.cumsum(np.where(gone, 0, length))])
