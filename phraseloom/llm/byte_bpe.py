"""Byte-level BPE: exact token counts at every prefix by dynamic programming, and cached encoding by the library.

The vocabulary file belongs to the ``tokenizers`` library (byte-level pre-tokenizer with its regex, no prefix blank).
Texts are cut into pieces by the tokenizer's own pattern; BPE never crosses a piece, so whatever is known of a piece is kept
in a bounded cache.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from . import cutting

#: Entries of each of the two generations of a worker's piece cache, and of its pair cache. What a full cache forgets is
#: worked out again: the size costs time and never changes a result.
CACHE = 400_000
#: The pre-tokenizer's published pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
#: The same pattern with its classes spelled out for the code points below, four times as fast.
LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
BEYOND_LATIN = re.compile(r"[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
FULL = regex.compile(PATTERN)
#: Runs of white space: one piece while nothing follows.
SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")


def byte_table() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stand for themselves."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, free = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in table:
            table[b], free = chr(free), free + 1
    return [table[b] for b in range(256)]


class PieceCache:
    """Pieces and what is known of them in two generations: a full young one becomes the old one, which is then dropped."""

    def __init__(self, learn, limit: int | None = None, times: float = 1):
        self._learn, self._limit, self._times, self.young, self._old = learn, limit, times, {}, {}

    def fill(self, pieces) -> dict:
        """The young generation, with all of ``pieces`` (distinct ones) in it."""
        if len(self.young) >= (self._limit or CACHE * self._times):
            self.young, self._old = {}, self.young
        young, old = self.young, self._old
        unknown = []
        for x in pieces:
            if x not in young:
                known = old.get(x)
                if known is None:
                    unknown.append(x)
                else:
                    young[x] = known
        if unknown:
            young.update(zip(unknown, self._learn(unknown), strict=True))
        return young


#: Classes of characters: letters, numbers, white space, and all others.
LETTER, NUMBER, SPACE, OTHER = range(4)


def _class(char: str) -> int:
    return next((k for k, group in ((LETTER, _L), (NUMBER, _N), (SPACE, _S)) if re.fullmatch(f"[{group}]", char)), OTHER)


TABLE = cutting.class_table(_class, OTHER)


def piece_starts(data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A mark on the first byte of every piece that the pattern finds in covered texts.

    A piece is a run of one class. Of white space before anything else the last character stands apart, and goes with what
    follows if it is a blank. A lone apostrophe before certain letters makes a piece with them.
    """
    n = len(data)
    text = cutting.text_starts(offsets, n)
    change, space, follows = np.ones(n, bool), kinds == SPACE, np.zeros(n, bool)  # follows: the byte goes with a blank before it
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
    follows[1:] = (data[:-1] == 0x20) & ~space[1:]
    starts = text | (change & ~follows)
    lead = (data & 0xC0) != 0x80
    # the last character of white space before something else of the same text
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~text[1:])
    last[~lead[last]] -= 1  # white space beyond ASCII has two bytes
    starts[last] = True
    mark = np.flatnonzero((data[:-1] == 0x27) & starts[:-1] & (kinds[1:] == LETTER) & ~text[1:])
    if len(mark):
        one, two = data[mark + 1], data[np.minimum(mark + 2, n - 1)]
        pair = ((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))
        pair &= (mark + 2 < n) & ~text[np.minimum(mark + 2, n - 1)]
        found = np.isin(one, np.frombuffer(b"stmd", np.uint8)) | pair
        mark, length = mark[found], np.where(pair[found], 3, 2)
        starts[mark + 1] = False
        after = mark + length
        starts[after[after < n]] = True
    return starts


class PieceSplitter:
    """Special strings first (as the library does by default), then the pattern's pieces."""

    def __init__(self, specials: dict[str, int]):
        self.specials = specials
        self._special = re.compile("(" + "|".join(re.escape(x) for x in sorted(specials, key=len, reverse=True)) + ")") if specials else None

    def segments(self, text: str) -> list[str]:
        """Ordinary and special segments in turn; specials stand at odd places."""
        if self._special is None or not any(x in text for x in self.specials):
            return [text]
        return self._special.split(text)

    def apart(self, data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts of a batch can't be cut together with others: special strings and uncovered characters."""
        out = cutting.beyond(kinds, offsets)
        whole = data.tobytes() if self.specials else b""
        for special in self.specials:
            own = special.encode()
            at = whole.find(own)
            while at >= 0:
                out[np.searchsorted(offsets, at, side="right") - 1] = True
                at = whole.find(own, at + 1)
        return out

    @staticmethod
    def pieces(segment: str) -> list[str]:
        return (LATIN if BEYOND_LATIN.search(segment) is None else FULL).findall(segment)


class PrefixCounter:
    """Exact token counts of every prefix.

    For bytes b[:i] of a piece the encoding's last token is the one token t ending at i whose predecessor, the last token of
    b[:i-len(t)], may stand before it: a sequence of tokens is what BPE yields exactly if each neighbouring pair is. So
    count[i] = count[i-len(t)] + 1, found left to right, and no prefix is ever encoded on its own.
    """

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))
        pre = model.get("pre_tokenizer") or {}
        if model["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or model.get("normalizer"):
            raise ValueError(f"{path}: a byte-level BPE vocabulary without prefix blank and normalizer is needed")
        back = {c: b for b, c in enumerate(byte_table())}
        added = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.vocab = {bytes(back[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in added}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.ranks = {(bytes(back[c] for c in a), bytes(back[c] for c in b)): k for k, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.vocab))
        self.bytes_of = {i: t for t, i in self.vocab.items()}
        self.split = PieceSplitter(added)
        lengths: dict[bytes, set[int]] = {}
        for t in self.vocab:
            lengths.setdefault(t[-2:], set()).add(len(t))
        #: By their last two bytes, the lengths of tokens, longest first.
        self.lengths = {end: tuple(sorted(own, reverse=True)) for end, own in lengths.items() if len(end) == 2}
        self.known = PieceCache(self._tables)
        self._pairs: dict[tuple[int, int], bool] = {}

    def merge(self, b: bytes) -> list[bytes]:
        """BPE by its definition, for short inputs: join the neighbouring pair of the lowest rank until none is left."""
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, a: int, b: int) -> bool:
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) >= CACHE:
                self._pairs.clear()
            x, y = self.bytes_of[a], self.bytes_of[b]
            found = self._pairs[a, b] = self.merge(x + y) == [x, y]
        return found

    def _extend(self, b: bytes, last: list[int], count: list[int]) -> None:
        """Go on with the programme from the prefix that ``last`` and ``count`` describe to all of ``b``."""
        vocab, follow, none = self.vocab, self._may_follow, ()
        for i in range(len(count), len(b) + 1):
            for size in self.lengths.get(b[i - 2 : i], none) if i > 1 else none:
                t = vocab.get(b[i - size : i]) if size <= i else None
                if t is not None and (size == i or follow(last[i - size], t)):
                    break
            else:
                t, size = vocab[b[i - 1 : i]], 1  # what ends here is a single byte
            last.append(t)
            count.append(count[i - size] + 1)

    def piece_counts(self, b: bytes) -> list[int]:
        """count[i] for i = 0..len(b): tokens of b[:i] within one piece."""
        last, count = [0], [0]
        self._extend(b, last, count)
        return count

    def _tables(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens of every prefix of each piece, by characters, as packed 32-bit integers. Neighbours in order share their prefix's part."""
        out: dict[bytes, bytes] = {}
        last, count, before = [0], [0], b""
        for piece in sorted(pieces):
            same, most = 0, min(len(piece), len(before))
            while same < most and piece[same] == before[same]:
                same += 1
            del last[same + 1 :], count[same + 1 :]
            self._extend(piece, last, count)
            before = piece
            table = count[1:] if piece.isascii() else [count[i] for i in range(1, len(piece) + 1) if i == len(piece) or piece[i] & 0xC0 != 0x80]
            if len(piece) == 3 and piece in (b"'re", b"'ve", b"'ll"):
                table[1] = sum(self.piece_counts(x.encode())[-1] for x in self.split.pieces(piece[:2].decode()))  # 'r of 're is two pieces
            out[piece] = array("i", table).tobytes()
        return [out[x] for x in pieces]

    def per_piece(self, text: str) -> tuple[list[str], list[int]]:
        """The pieces of a text and the tokens of each; a special string is a piece of one token."""
        pieces: list[str] = []
        counts: list[int] = []
        for k, segment in enumerate(self.split.segments(text)):
            if k % 2:
                pieces.append(segment)
                counts.append(1)
                continue
            found = self.split.pieces(segment)
            pieces += found
            own = [x.encode() for x in found]
            known = self.known.fill(set(own))
            counts += [int.from_bytes(known[x][-4:], sys.byteorder) for x in own]
        return pieces, counts

    def count(self, text: str) -> int:
        return sum(self.per_piece(text)[1])

    def prefix_counts_of(self, column: pa.Array) -> list[np.ndarray]:
        """prefix_counts of every text of a column (null: empty), worked out together."""
        data, offsets = cutting.bytes_of(column)
        kinds = cutting.classes(data, TABLE)
        slow = self.split.apart(data, kinds, offsets)
        out = {i: self.prefix_counts(column[int(i)].as_py()) for i in np.flatnonzero(slow)}
        if out:
            data, offsets = cutting.without(data, offsets, slow)
            kinds = cutting.classes(data, TABLE)
        if not len(data):
            return [out[i] if i in out else np.zeros(1, np.int32) for i in range(len(column))]
        starts = np.flatnonzero(piece_starts(data, kinds, offsets))
        which, pieces = cutting.distinct_pieces(data, starts)
        known = self.known.fill(pieces)
        tables = [known[x] for x in pieces]
        sizes = np.fromiter(map(len, tables), np.int64, len(tables)) // 4
        flat, first = np.frombuffer(b"".join(tables), np.int32), np.cumsum(sizes) - sizes
        tokens = flat[first + sizes - 1].astype(np.int64)[which]
        before = np.cumsum(tokens) - tokens
        heads = np.searchsorted(starts, offsets)
        before -= np.repeat(np.append(before, 0)[heads[:-1]], np.diff(heads))
        inside = cutting.gather(flat, first[which], sizes[which]) + np.repeat(before, sizes[which]).astype(np.int32)
        char_at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
        self._white_space(data, kinds, offsets, char_at, inside)
        ends = char_at[offsets]
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            if i not in out:
                out[i] = np.concatenate([np.zeros(1, np.int32), inside[a:b]])
        return [out[i] for i in range(len(column))]

    def _white_space(self, data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray, char_at: np.ndarray, inside: np.ndarray) -> None:
        """Within a run of white space every prefix ends in one piece, that of the run so far."""
        space, text = np.append(kinds == SPACE, False), np.append(cutting.text_starts(offsets, len(data)), True)
        edge = np.flatnonzero((space[1:] != space[:-1]) | (text[1:] & space[1:])) + 1
        begin = edge[space[edge]]
        if space[0]:
            begin = np.append(0, begin)
        stops = np.flatnonzero(space[:-1] & (~space[1:] | text[1:])) + 1
        long = char_at[stops] - char_at[begin] > 1
        for a, b in zip(begin[long].tolist(), stops[long].tolist(), strict=True):
            run = data[a:b].tobytes()
            table = np.frombuffer(self.known.fill([run])[run], np.int32)
            at = int(char_at[a])
            inside[at : at + len(table)] = (0 if text[a] else int(inside[at - 1])) + table

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for every i from 0 to len(text), each exactly as if that prefix were encoded alone.

        Within a piece the table of piece_counts holds. Three kinds of prefixes are cut into pieces differently from the
        whole text, and only their own last piece is looked at again: inside a run of white space (one piece while nothing
        follows it), inside a contraction ('r of 're), and inside a special string (ordinary text until it is complete).
        """
        out = np.zeros(len(text) + 1, dtype=np.int32)
        at = base = 0
        for k, segment in enumerate(self.split.segments(text)):
            start = at
            at += len(segment)
            if k % 2:
                # up to its last character the special string is ordinary text that goes on with the segment before
                before = self.split.segments(text[:start])[-1]
                tail_base = base - self.count(before)
                for i in range(1, len(segment)):
                    out[start + i] = tail_base + self.count(before + segment[:i])
                base += 1
                out[at] = base
                continue
            if not segment:
                continue
            found = [x.encode() for x in self.split.pieces(segment)]
            known = self.known.fill(set(found))
            inside = np.frombuffer(b"".join([known[x] for x in found]), np.int32)
            lengths = np.fromiter((len(known[x]) // 4 for x in found), np.int64, len(found))
            sums = np.cumsum(inside[np.cumsum(lengths) - 1])
            out[start + 1 : at + 1] = inside + np.repeat(base + np.concatenate([[0], sums[:-1]]), lengths)
            for m in SPACES.finditer(segment):
                run = m.group().encode()
                head = int(out[start + m.start()]) if m.start() else base
                table = np.frombuffer(self.known.fill([run])[run], np.int32)
                out[start + m.start() + 1 : start + m.end() + 1] = head + table
            base += int(sums[-1])
        return out


class PieceEncoder:
    """The library's ids, encoded once for each piece of the cache; texts beyond the table go to it whole."""

    def __init__(self, path: str):
        # a task has one core: the library's own threads would only contend for it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code, self.kind = "H" if self.width == 2 else "I", np.dtype(f"<u{self.width}")
        self.split = PieceSplitter(added)
        self.printable = {b: ord(c) for b, c in enumerate(byte_table())}
        self.known = PieceCache(self._learn, times=1.5)  # ids are shorter than tables of prefixes

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of single pieces: the library's model on their bytes' stand-ins, as its pre-tokenizer would hand them over."""
        tokenize, table = self.tokenizer.model.tokenize, self.printable
        out = [array(self.code, [t.id for t in tokenize(p.decode("latin-1").translate(table))]) for p in pieces]
        if sys.byteorder == "big":
            for x in out:
                x.byteswap()
        return [x.tobytes() for x in out]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``width`` bytes."""
        return [x.tobytes()[: -self.width] for x in self.encode_column(pa.array(texts, pa.string()), 0)]

    def encode_column(self, column: pa.Array, end_id: int) -> list[np.ndarray]:
        """Ids of every text of a column (null: none), each followed by ``end_id``; little-endian, ``width`` bytes."""
        data, offsets = cutting.bytes_of(column)
        kinds = cutting.classes(data, TABLE)
        slow = self.split.apart(data, kinds, offsets)
        whole = np.flatnonzero(slow).tolist()
        if whole:
            data, offsets = cutting.without(data, offsets, slow)
            kinds = cutting.classes(data, TABLE)
        starts = np.flatnonzero(piece_starts(data, kinds, offsets)) if len(data) else np.zeros(0, np.int64)
        which, pieces = cutting.distinct_pieces(data, starts)
        known = self.known.fill(pieces)
        ids = [known[x] for x in pieces]
        flat = np.frombuffer(b"".join([*ids, np.array([end_id], self.kind).tobytes()]), self.kind)
        sizes = np.fromiter([*map(len, ids), self.width], np.int64, len(ids) + 1) // self.width
        first = np.cumsum(sizes) - sizes
        heads = np.searchsorted(starts, offsets)
        which = np.insert(which, heads[1:], len(ids))  # the end id is one more piece
        length = sizes[which]
        joined = cutting.gather(flat, first[which], length)
        ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], heads[1:] + np.arange(1, len(heads))])]
        out = [joined[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i, own in zip(whole, self._encode([column[i].as_py() for i in whole]), strict=True):
            out[i] = np.append(own, np.array([end_id], self.kind))
        return out


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter for each worker and vocabulary."""
    return PrefixCounter(path)


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)
