"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tallyframe.llm.common import append_columns, narrowed

#: Pieces and token pairs of a generation. A worker remembers two generations of pieces, the last one and what was
#: used of it since; of pairs it forgets all beyond that.
PIECES, PAIRS = 200_000, 150_000
#: Matches handled at a time in a very long text.
RUN = 1 << 18


class _Known(dict):
    """Token ids of a string, found on the first look-up."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.last = encode, most, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.last = dict(self)
            self.clear()
        ids = self.last.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(text) <= 64:
            self[text] = ids
        return ids


class ByteBPE:
    """An encoder that gives exactly the merges of byte-pair encoding, in time linear in the text.

    A sequence of tokens is the BPE result if and only if each two adjacent tokens are, that is, if merging the bytes
    of the pair gives the same pair again. Every prefix of a piece therefore has one valid sequence at most, and a
    depth-first search from the longest match at each position, which leaves a position for good once it failed,
    visits each position once.
    """

    def __init__(self, path: str, pattern: str, newer: str = ""):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.sizes = list(map(len, self.tokens))
        self.decimal = list(map(str, range(len(self.tokens))))
        self.pattern, self.exact, self.newer = regex.compile(pattern), narrowed(pattern, newer), frozenset(newer)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        automaton = ahocorasick.Automaton()
        reached = {}
        for rank in sorted(self.ranks.values()):
            token = self.tokens[rank]
            if len(token) == 1 or self._learn(rank, token):
                automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
                reached[token] = rank
        # The longest token that begins a token, -1 if there is none.
        self.shorter = [next((reached[t[:cut]] for cut in range(len(t) - 1, 0, -1) if t[:cut] in reached), -1) for t in self.tokens]
        automaton.make_automaton()
        self.find = automaton.iter
        self.pieces = _Known(self._encode_piece, PIECES)

    def _learn(self, rank: int, token: bytes) -> bool:
        """Find the two tokens whose merge makes this one. Ranks come in rising order, so both are known."""
        ranks = self.ranks
        for cut in range(len(token) - 1, 0, -1):
            left, right = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
            if left < rank and right < rank and self._adjacent(left, right):
                self.halves[rank] = (left, right)
                self.merged[left, right] = rank
                return True
        return False  # no merge reaches it; it stands only where a whole piece equals it

    def _adjacent(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side.

        Undoes their merges from the latest to the earliest and looks whether, at any such moment, a merge across
        the border would have come first.
        """
        merged, halves = self.merged, self.halves
        limit = len(self.tokens)
        while True:
            across = merged.get((left, right))
            if across is not None and across < limit:
                return False
            # Of two merges, the one of the higher rank came last; of two equal ones, the right one.
            for side in ("left", "right") if left > right else ("right", "left"):
                token = left if side == "left" else right
                if token in halves:
                    break
            else:
                return True
            if side == "left":
                limit, left = left, halves[left][1]
            else:
                limit, right = right + 1, halves[right][0]

    def adjacent(self, left: int, right: int) -> bool:
        known = self.known
        found = known.get((left, right))
        if found is None:
            if len(known) >= PAIRS:
                known.clear()
            found = known[left, right] = self._adjacent(left, right)
        return found

    def _encode_piece(self, text: str) -> tuple[int, ...]:
        piece = text.encode()
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n, sizes, shorter, adjacent = len(piece), self.sizes, self.shorter, self.adjacent
        longest = [-1] * n
        for end, (back, token) in self.find(piece.decode("latin-1")):
            longest[end - back] = token  # longer ones come later
        failed = bytearray(n + 1)
        chosen: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            while token >= 0 and (failed[at + sizes[token]] or (last >= 0 and not adjacent(last, token))):
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at += sizes[token]
                if at == n:
                    return tuple(chosen)
                last, token = token, longest[at]
            else:
                failed[at] = 1
                back = chosen.pop()
                at -= sizes[back]
                last, token = chosen[-1] if chosen else -1, shorter[back]

    def runs(self, text: str) -> Iterator[list[int]]:
        """Ids of the text, a bounded number of pieces at a time."""
        look = self.pieces.__getitem__
        pattern = self.pattern if text.isascii() or self.newer.isdisjoint(text) else self.exact
        if len(text) <= RUN:
            yield list(chain.from_iterable(map(look, pattern.findall(text))))
            return
        pieces = (m.group() for m in pattern.finditer(text))
        while part := list(islice(pieces, RUN)):
            yield list(chain.from_iterable(map(look, part)))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.runs(text or "")))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the bytes the ids decode to."""
        count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.runs(text or ""):
            if ids:
                ids_hash.update((("," if count else "") + ",".join(map(self.decimal.__getitem__, ids))).encode())
                text_hash.update(self.decode(ids))
                count += len(ids)
        return count, ids_hash.hexdigest(), text_hash.hexdigest()


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Letters and numbers that the regex module knows and the tables of the tiktoken library do not have yet."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = set()
    for kind in (r"\p{L}", r"\p{N}"):
        theirs = tiktoken.Encoding("bytes", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        found |= set(regex.findall(kind, every)) - set(bytes(theirs.encode_ordinary(every)).decode())
    return "".join(sorted(found))


@lru_cache(maxsize=2)
def _loaded(path: str, pattern: str, newer: str) -> ByteBPE:
    return ByteBPE(path, pattern, newer)


def codec(path: str, pattern: str, newer: str = "") -> ByteBPE:
    """One codec for each Python worker. ``path`` is a file every worker sees, or the name of one given to addFile."""
    import os

    return _loaded(path if os.path.isabs(path) else SparkFiles.get(path), pattern, newer)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``token_ids array<int>``, ``n_tokens long`` and ``exact boolean``: the ids decode to the text's bytes.

    Each match of ``pattern``, as the tiktoken library's character tables have it, is encoded separately; strings of special tokens are ordinary text. A null or empty
    text gives an empty array and 0. Rows, also repeated ones, stay as they are and nothing is shuffled; columns named
    like the new ones are replaced. A very long text is read a bounded number of pieces at a time.
    """

    newer = newer_characters()

    def make(texts):
        tool = codec(path, pattern, newer)
        lists, exact = [], []
        for t in texts:
            ids = tool.encode(t)
            exact.append(tool.decode(ids) == (t or "").encode())
            lists.append(np.array(ids, np.int32))
        ends = np.cumsum([0, *map(len, lists)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*lists, np.empty(0, np.int32)])))
        return [ids, np.diff(ends).tolist(), exact]

    return append_columns(df, [text], "token_ids array<int>, n_tokens long, exact boolean", make)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """Add ``decoded binary``, the bytes that the ids stand for. A null array gives null, an empty one no bytes."""

    def make(lists):
        tool = codec(path, pattern)
        return [[None if x is None else tool.decode(x) for x in lists]]

    return append_columns(df, [ids], "decoded binary", make)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode each text, decode the ids, and add ``n_tokens long, ids_sha256 string, decoded_sha256 string``.

    The same coding as :func:`encode` followed by :func:`decode`, without moving ids and bytes between processes.
    """

    newer = newer_characters()

    def make(texts):
        digests = codec(path, pattern, newer).digests
        return list(zip(*map(digests, texts)))

    return append_columns(df, [text], "n_tokens long, ids_sha256 string, decoded_sha256 string", make, keep)
