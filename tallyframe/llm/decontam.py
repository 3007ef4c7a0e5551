"""Benchmark decontamination: suffix arrays over the training words of each shard, searched with every test suffix."""

from __future__ import annotations

from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import append_columns, without, words_of
from tallyframe.session import stage

#: Bytes of test texts that are searched in one pass over the documents; more are searched in more passes. The arrays made of
#: them take some 25 times as much in each Python worker while they are built, less than 250 MB.
TEST_BYTES = 8 << 20


class _Known(dict):
    """Numbers of the test words; any other word is 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _runs(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal key and consecutive position in sorted rows."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)
    return np.flatnonzero(fresh)


class TestSet:
    """All suffixes of the test items that are long enough to count, cut to the window length.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    """

    __test__ = False  # not a test case

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.known = _Known()
        names: dict[str, int] = {}
        owner, sizes, parts = [], [], []
        border = np.zeros(window, np.uint32)
        for name, text in items:
            words = words_of(text)
            if words:
                ids = (self.known.setdefault(w, len(self.known) + 1) for w in words)
                parts += [np.fromiter(ids, np.uint32, len(words)), border]
                owner.append(names.setdefault(name, len(names)))
                sizes.append(len(words))
        self.names = list(names)
        numbers, sizes = np.concatenate([border, *parts]), np.array(sizes, np.int64)
        # Every window of every item: the item's number here, its place in the item and in the numbers.
        each = np.maximum(sizes - window, 0) + 1
        item = np.repeat(np.arange(len(sizes)), each)
        offset = np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)
        at = (window + np.cumsum(sizes + window) - (sizes + window))[item] + offset
        self.low, first, spot = np.unique(self._packed(numbers, at), return_index=True, return_inverse=True)
        self.lengths = np.minimum(sizes, window)[item[first]]
        # The last string that begins with a shorter suffix; a whole window is its own.
        self.short = np.flatnonzero(self.lengths < window)
        last = numbers[at[first[self.short], None] + np.arange(window)]
        last[np.arange(window) >= self.lengths[self.short, None]] = 0xFFFFFFFF
        self.high = self._strings(last)
        order = np.argsort(spot, kind="stable")
        self.spot_ends = np.concatenate([[0], np.cumsum(np.bincount(spot, minlength=len(self.low)))])
        self.spot_item, self.spot_word = np.array(owner, np.int32)[item[order]], offset[order].astype(np.int32)
        base = len(self.known) + 2
        self.lead = int(min(self.lengths.min(initial=window), 3 if base < 2_000_000 else 2))
        self.powers = [base**i for i in range(self.lead)]
        self.leads = np.unique(sum((numbers[at[first] + i].astype(np.int64) * p for i, p in enumerate(self.powers)), np.zeros(len(first), np.int64)))

    def _strings(self, rows: np.ndarray) -> np.ndarray:
        """Rows of word numbers as byte strings whose order is the order of the words."""
        return np.ascontiguousarray(rows, ">u4").view(f"S{4 * self.window}").ravel()

    def _packed(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The window of words from each place, as a byte string."""
        return self._strings(numbers.astype(">u4")[at[:, None] + np.arange(self.window)])

    def suffix_array(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted suffixes, cut to the window length, and their positions.

        Left out are suffixes that no test suffix can start with: those whose first words are not the first
        words of any. ``numbers`` must end in as many zeros as the window has words.
        """
        n = len(numbers) - self.window
        wide = numbers.astype(np.int64)
        code, fine = np.zeros(n, np.int64), np.ones(n, bool)
        for i, power in enumerate(self.powers):
            code += wide[i : n + i] * power
            fine &= numbers[i : n + i] > 0
        at = np.flatnonzero(fine)
        where = np.searchsorted(self.leads, code[at])
        at = at[self.leads[np.minimum(where, len(self.leads) - 1)] == code[at]]
        suffixes = self._packed(numbers, at)
        order = np.argsort(suffixes, kind="stable")
        return suffixes[order], at[order]

    def search(self, texts: list[str | None]) -> tuple[list[int], list[list[dict]], list[list[dict]]]:
        """Number of words, hit stretches and longest matches of each document of a shard."""
        counts, parts = [], []
        border = np.zeros(self.window, np.uint32)
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            parts += [np.fromiter(map(self.known.__getitem__, words), np.uint32, len(words)), border]
        hits, matches = [[] for _ in texts], [[] for _ in texts]
        if not len(self.lengths) or not texts:
            return counts, hits, matches
        numbers = np.concatenate(parts)
        starts = np.cumsum([0] + [c + self.window for c in counts])
        suffixes, at = self.suffix_array(numbers)
        first, last = np.searchsorted(suffixes, self.low, "left"), np.searchsorted(suffixes, self.low, "right")
        last[self.short] = np.searchsorted(suffixes, self.high, "right")
        found = last - first
        which = np.repeat(np.arange(len(found)), found)
        if not len(which):
            return counts, hits, matches
        place = at[np.repeat(first, found) + np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)]
        edge = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + self.lengths[which], -1)
        covered = np.flatnonzero(np.cumsum(edge) > 0)
        doc = np.searchsorted(starts, covered, "right") - 1
        run = _runs(doc, covered)
        for d, word, size in zip(doc[run].tolist(), (covered[run] - starts[doc[run]]).tolist(), np.diff([*run, len(covered)]).tolist()):
            hits[d].append({"word": word, "words": size})
        # Windows of one item that follow one another on both sides make one longer match.
        uses = self.spot_ends[which + 1] - self.spot_ends[which]
        spot = np.repeat(self.spot_ends[which], uses) + np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
        place, size = np.repeat(place, uses), np.repeat(self.lengths[which], uses)
        item, offset = self.spot_item[spot], self.spot_word[spot]
        order = np.lexsort((place, place - offset, item))
        place, size, item, offset = place[order], size[order], item[order], offset[order]
        run = _runs(item * (len(numbers) + 1) + place - offset, place)
        doc = np.searchsorted(starts, place[run], "right") - 1
        spans = np.diff([*run, len(place)]) - 1 + size[run]
        for d, i, o, p, s in zip(doc.tolist(), item[run].tolist(), offset[run].tolist(), (place[run] - starts[doc]).tolist(), spans.tolist()):
            matches[d].append({"item_id": self.names[i], "item_word": o, "word": p, "words": s})
        return counts, hits, matches


_SENT: dict[bytes, Broadcast] = {}


@lru_cache(maxsize=1)
def _built(digest: bytes, window: int) -> TestSet:
    return TestSet(_SENT[digest].value, window)


def _test_set(sent: Broadcast, digest: bytes, window: int) -> TestSet:
    """The test set of a broadcast, built once in each Python worker and known by the digest of its items."""
    _SENT.clear()
    _SENT[digest] = sent
    return _built(digest, window)


def _merged(stretches: list[dict]) -> list[dict]:
    """Union of stretches that may overlap."""
    out: list[dict] = []
    for s in sorted(stretches, key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["word"] + out[-1]["words"]:
            out[-1]["words"] = max(out[-1]["words"], s["word"] + s["words"] - out[-1]["word"])
        else:
            out.append({"word": s["word"], "words": s["words"]})
    return out


FOUND = (
    "n_words long, hits array<struct<word:bigint,words:bigint>>, "
    "matches array<struct<item_id:string,item_word:bigint,word:bigint,words:bigint>>"
)


def find_matches(
    df: DataFrame, tests: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, test_bytes: int = TEST_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``hits`` (disjoint stretches of hit words) and ``matches`` (longest verbatim matches with places).

    Words are runs of digits, letters and non-ASCII characters with A-Z lower-cased, of whole texts. A word is hit if it lies in an
    occurrence of a window of some item. A match is as long as document and item agree word by word, at least one window;
    ``item_word`` and ``word`` count from 0. Null or empty texts have no words and no matches; null or empty items match nothing; a
    null item_id reads "null"; repeated items count under their id once per place. Repeated documents are searched each.
    Columns named like the new ones are replaced. Rows stay where they are: every Arrow batch is a shard.

    The items are broadcast in parts of ``test_bytes`` of text, each searched by a pass of its own. With more than one part the
    documents are written once with a row number, each pass writes what it found, and the finds are put together by that
    number, so that no task ever holds more than one part.
    """
    spark = df.sparkSession
    items = tests.select(F.coalesce(tests[item_id].cast("string"), F.lit("null")).alias("i"), tests[item_text].alias("t")).where("t is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    passes = max(1, -(-total // test_bytes))

    def searched(docs: DataFrame, part: DataFrame, column: str, kept: list[str] | None) -> DataFrame:
        rows = sorted(tuple(r) for r in part.collect())
        digest = blake2b(repr(rows).encode()).digest()
        sent = spark.sparkContext.broadcast(rows)
        return append_columns(docs, [column], FOUND, lambda texts: _test_set(sent, digest, window).search(texts), kept)

    if passes == 1:
        return searched(df, items, text, keep)
    kept = without(df if keep is None else df.select(*keep), ["n_words", "hits", "matches"])
    docs = df.select(F.struct(*[df[c] for c in kept]).alias("row"), df[text].alias("text"), F.monotonically_increasing_id().alias("number"))
    docs = stage(docs, "decontam-documents")
    parts = [items.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == k) for k in range(passes)]
    found = [searched(docs.select("number", "text"), part, "text", ["number"]) for part in parts]
    found = [stage(f if k == 0 else f.where(F.size("hits") > 0), "decontam-found") for k, f in enumerate(found)]
    whole = reduce(DataFrame.unionByName, found).groupBy("number").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("matches")).alias("matches")
    )
    whole = append_columns(whole, ["hits"], FOUND.split(", ")[1], lambda hits: [[_merged(h) for h in hits]])
    return docs.select("row", "number").join(whole, "number").select("row.*", "n_words", "hits", "matches")


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["words"])


def clean(df: DataFrame, tests: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The documents without any hit word, with their columns unchanged. Same rules as :func:`find_matches`."""
    kept = df.select(F.struct("*").alias("row"), F.col(text).alias("__t"))
    return find_matches(kept, tests, window, "__t", keep=["row"]).where(F.size("hits") == 0).select("row.*")
