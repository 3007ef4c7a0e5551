"""Token counts: byte-pair merging over a heap of adjacent pairs and a linked list of symbols; no ids are made."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers

from tallyframe.llm.common import append_columns, narrowed

#: Pieces whose counts a worker remembers, and matches handled at a time in a very long text.
PIECES, RUN = 250_000, 1 << 18
#: Fixed value: how the byte-level pre-tokenizer of these files splits a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Counts(dict):
    """Number of tokens of a piece, found on the first look-up; short pieces are remembered, all forgotten when there are too many."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, piece: str) -> int:
        found = self.count(piece)
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = found
        return found


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _require(spec: dict) -> None:
    """Raise ValueError for a file that asks for more than plain byte-level BPE."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (
        spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip"))
    )
    if not plain:
        raise ValueError("only byte-level BPE without normalizer, affixes and stripping tokens is supported")


class PairMerger:
    """Counts the tokens of texts as the library that reads ``path`` does."""

    def __init__(self, path: str, newer: str = ""):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _require(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.first = [vocab[c] for c in byte_letters()]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left], vocab[right]] = rank
            self.made.append(vocab[left + right])
        special = sorted((t["content"] for t in spec.get("added_tokens", []) if t["content"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) if special else r"(?!)")
        self.pattern, self.exact, self.newer = regex.compile(BYTE_LEVEL), narrowed(BYTE_LEVEL, newer), frozenset(newer)
        self.counts = _Counts(self.merge)

    def merge(self, piece: str) -> int:
        """Number of tokens of one piece: its bytes less the merges made.

        The heap holds a number ``rank * n + place`` for each adjacent pair that some merge joins, so the lowest rank comes
        first and of equal ones the leftmost. A pair that changed since it was pushed is passed over. Time is
        n log n, memory about 50 bytes for each byte of the piece.
        """
        symbols = [self.first[b] for b in piece.encode()]
        n, ranks = len(symbols), self.ranks
        heap = [r * n + i for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]), -1)) >= 0]
        if not heap:
            return n
        heapify(heap)
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        merges = 0
        while heap:
            rank, at = divmod(heappop(heap), n)
            right = after[at]
            if right >= n or ranks.get((symbols[at], symbols[right])) != rank:
                continue
            symbols[at], symbols[right] = self.made[rank], -1
            merges += 1
            after[at] = end = after[right]
            if end < n:
                before[end] = at
                if (r := ranks.get((symbols[at], symbols[end]), -1)) >= 0:
                    heappush(heap, r * n + at)
            if (left := before[at]) >= 0 and (r := ranks.get((symbols[left], symbols[at]), -1)) >= 0:
                heappush(heap, r * n + left)
        return n - merges

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        split = self.pattern if text.isascii() or self.newer.isdisjoint(text) else self.exact
        if len(text) <= RUN:
            return sum(map(self.counts.__getitem__, split.findall(text)))
        pieces, total = (m.group() for m in split.finditer(text)), 0
        while part := list(islice(pieces, RUN)):
            total += sum(map(self.counts.__getitem__, part))
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a text; each special string in it is one token, as the library reads them by default."""
        parts = self.special.split(text or "")
        return len(parts) - 1 + sum(map(self._plain, parts))


@lru_cache(maxsize=2)
def merger(path: str, newer: str) -> PairMerger:
    """One merger for each Python worker and file."""
    return PairMerger(path, newer)


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Letters and numbers that the regex module knows and the tokenizers library's tables do not have yet."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = set()
    for inside, outside in ((r"\p{L}", r"\P{L}"), (r"\p{N}", r"\P{N}")):
        found |= set(regex.findall(inside, every)) - set(normalizers.Replace(Regex(outside), "").normalize_str(every))
    return "".join(sorted(found))


def count_tokens(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_bytes long`` (UTF-8) and ``n_tokens long``: the tokens that the library for the file ``path`` gives the whole text.

    No begin, end or other tokens are added and nothing is cut. A null or empty text has 0 of both. Rows, also repeated
    ones, stay where they are: nothing is shuffled. Columns named like the new ones are replaced. Very long texts are read a bounded
    number of pieces at a time; a single piece (a run of letters, say) is merged as a whole. ``path`` is a file that every
    executor has; a file that is no plain byte-level BPE raises ValueError.
    """
    newer = newer_characters()

    def make(texts):
        count = merger(path, newer).count
        return [[len(t.encode()) if t else 0 for t in texts], list(map(count, texts))]

    return append_columns(df, [text], "n_bytes long, n_tokens long", make, keep)
