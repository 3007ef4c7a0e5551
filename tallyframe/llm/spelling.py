"""Spelling variants: words one edit apart, by composing the vocabulary's acceptor with a one-edit transducer and itself."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import stage

#: Different words that a task counts before it hands them on, and characters read at a time in a very long text.
HELD_WORDS, LONG_TEXT = 200_000, 1 << 20
#: Words of one partition of the composition; a larger partition is divided.
PARTITION_WORDS = 20_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def _words_of(name: str, text: str, slip: int | None) -> Iterator[tuple[str, int]]:
    """Different words of one text with their counts; see :func:`count_words` for ``slip``."""
    text = text.encode().lower().decode()  # bytes lower-case A-Z alone
    found = Counter(_RUN.findall(text) if len(text) <= LONG_TEXT else (m.group() for m in _RUN.finditer(text)))
    if not slip:
        yield from found.items()
        return
    start = crc32(f"{name}:".encode())
    for run, n in found.items():
        h = crc32(run.encode(), start)
        if h % slip == 0:
            h %= len(run)
            run = run[:h] + run[h + 1 :]
        yield run, n


def count_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 5, min_count: int = 3, slip: int | None = None) -> DataFrame:
    """Rows (word, n long): the runs ``[A-Za-z\\u00C0-\\u00FF]+`` of all texts with A-Z lower-cased, and how often each stands.

    Only words of ``min_length`` code points and ``min_count`` occurrences. With ``slip``, a run loses a code point wherever that number divides
    the CRC-32 of ``<doc_id>:<run>`` (an id that is null counts as an empty one). Null texts have no words; repeated rows count each time;
    other columns are not read. Tasks hand on partial counts, at most ``HELD_WORDS`` words at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, t in zip(batch.column(0), batch.column(1)):
                for word, n in _words_of(name.as_py() or "", t.as_py() or "", slip):
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield counted()
                    held.clear()
        yield counted()

    parts = df.select(df[doc_id].cast("string").alias("name"), df[text].alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Acceptor:
    """The minimised acceptor of sorted different strings, which also numbers them in order.

    ``arcs[state]`` maps a symbol to (next state, number of the state's strings before those of this arc). ``spans[state]`` holds the
    least and the greatest length of the strings accepted from there.
    """

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.sizes: list[int] = []
        self.spans: list[tuple[int, int]] = []
        known: dict[tuple, int] = {}
        # Unfinished states along the last word: symbol that led there, finished arcs, whether a word ends here.
        path: list[tuple[str, list[tuple[str, int]], list[bool]]] = [("", [], [False])]
        last = ""

        def close(down_to: int) -> None:
            while len(path) > down_to + 1:
                symbol, arcs, ends = path.pop()
                path[-1][1].append((symbol, self._state(known, ends[0], arcs)))

        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            close(same)
            path.extend((c, [], [False]) for c in word[same:])
            path[-1][2][0] = True
            last = word
        close(0)
        self.start = self._state(known, path[0][2][0], path[0][1])

    def _state(self, known: dict[tuple, int], final: bool, arcs: list[tuple[str, int]]) -> int:
        """The state with these arcs, one for all equal ones."""
        name = (final, *arcs)
        state = known.get(name)
        if state is None:
            state = known[name] = len(self.arcs)
            numbered, before = {}, int(final)
            for symbol, to in arcs:
                numbered[symbol] = (to, before)
                before += self.sizes[to]
            lengths = [n + 1 for _, to in arcs for n in self.spans[to]] + [0] * final
            self.arcs.append(numbered)
            self.final.append(final)
            self.sizes.append(before)
            self.spans.append((min(lengths, default=0), max(lengths, default=-1)))
        return state


class OneEdit:
    """Acceptor, one-edit transducer and acceptor composed; states of the product are made as they are reached.

    The transducer copies in its state 0. A replaced symbol leads to state 1, where all else is copied. A removed symbol leads to a
    state that copies too, but not the removed symbol first, so each pair is accepted by one path only: the edit stands at
    the first difference. Both acceptors are in one state as long as nothing was edited. Strings have ``length`` or ``length + 1``
    symbols: two of ``length`` may differ by a replacement, two of both lengths by a removal.
    """

    def __init__(self, words: Iterable[str], length: int):
        self.acceptor, self.length = Acceptor(words), length
        self.known: dict[tuple[int, int, int], list[tuple[int, int]]] = {}

    def copied(self, p: int, q: int, rest: int, but: str = "") -> list[tuple[int, int]]:
        """Numbers, counted from p and from q, of the strings of ``rest`` symbols accepted from both that do not begin with ``but``."""
        arcs, spans = self.acceptor.arcs, self.acceptor.spans
        if not (spans[p][0] <= rest <= spans[p][1] and spans[q][0] <= rest <= spans[q][1]):
            return []
        if not but and (p, q, rest) in self.known:
            return self.known[p, q, rest]
        name, from_p, from_q, found = (p, q, rest), 0, 0, None
        while found is None:
            if rest == 0:
                found = [(from_p, from_q)] if self.acceptor.final[p] and self.acceptor.final[q] else []
                break
            ways = []
            for symbol, (to_p, skip_p) in arcs[p].items():
                if symbol != but and (other := arcs[q].get(symbol)) is not None:
                    to_q, skip_q = other
                    if spans[to_p][0] < rest <= spans[to_p][1] + 1 and spans[to_q][0] < rest <= spans[to_q][1] + 1:
                        ways.append((to_p, skip_p, to_q, skip_q))
            but_now, but = but, ""
            rest -= 1
            if len(ways) == 1:  # follow a path without branches in place
                p, skip_p, q, skip_q = ways[0]
                from_p, from_q = from_p + skip_p, from_q + skip_q
            else:
                found = [(from_p + sp + a, from_q + sq + b) for tp, sp, tq, sq in ways for a, b in self.copied(tp, tq, rest)]
            if but_now:
                name = None
        if name is not None:
            self.known[name] = found
        return found

    def pairs(self, edits: int) -> Iterator[tuple[int, int]]:
        """Numbers of the accepted pairs whose edit stands at a place below ``edits``, each pair once."""
        arcs, spans = self.acceptor.arcs, self.acceptor.spans
        waiting = [(self.acceptor.start, 0, 0)]
        while waiting:
            state, before, place = waiting.pop()
            if place >= edits:
                continue
            out, rest = list(arcs[state].items()), self.length - place
            for i, (a, (to, skip)) in enumerate(out):
                waiting.append((to, before + skip, place + 1))
                for _, (other, other_skip) in out[i + 1 :]:
                    for x, y in self.copied(to, other, rest - 1):
                        yield before + skip + x, before + other_skip + y
                if spans[to][0] <= rest <= spans[to][1]:
                    for x, y in self.copied(to, state, rest, but=a):
                        yield before + skip + x, before + y


def _partitions(rows: DataFrame) -> DataFrame:
    """Add ``key``, which names the partition of each row (word, n, size, low, high), and ``middle``, what is free in it.

    A row stands for the pairs of class ``size``: words of ``size`` code points, and of one more, that first differ at a place from ``low`` up
    to, not including, ``high``. Such pairs agree in their first ``low`` code points, the initial state, and in their last ``size - high``.
    """
    tail = F.expr("greatest(size - high, 0)")
    key = F.concat_ws(":", "size", "low", "high", F.expr("substring(word, 1, low)"), F.right("word", tail))
    return rows.withColumn("key", key).withColumn("middle", F.expr("substring(word, low + 1, char_length(word) - low - greatest(size - high, 0))"))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row's places cut in two."""
    cut = F.expr("cast((low + high + 1) div 2 as int)")
    ways = F.array(F.struct(F.col("low"), cut.alias("high")), F.struct(cut.alias("low"), F.col("high")))
    return rows.select("word", "n", "size", F.explode(ways).alias("w")).select("word", "n", "size", "w.low", "w.high")


def _near(rows: DataFrame) -> DataFrame:
    """Rows (word, n_near, best): for each word the words near it in one partition, and (-n, word) of the best of them."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])

        for _, group in groupby(members(batches), itemgetter(0)):
            group = list(group)
            _, _, word, _, size, low, high = group[0]
            if len(group) == 1 or all(len(g[2]) > size for g in group):
                continue
            middles, words, counts = [g[1] for g in group], [g[2] for g in group], [g[3] for g in group]
            length = len(middles[0]) - (len(word) - size)
            near, best = [0] * len(group), [None] * len(group)
            for i, j in OneEdit(middles, length).pairs(high - low):
                for a, b in ((i, j), (j, i)):
                    near[a] += 1
                    if best[a] is None or (-counts[b], words[b]) < (-counts[best[a]], words[best[a]]):
                        best[a] = b
            out += [(words[i], near[i], counts[best[i]], words[best[i]]) for i in range(len(group)) if near[i]]
            if len(out) > 50_000:
                yield made()
                out = []
        if out:
            yield made()

    dealt = rows.repartition("key").sortWithinPartitions("key", "middle").select("key", "middle", "word", "n", "size", "low", "high")
    return dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")


def near_words(words: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """Rows (word, n_near, best_n, best), one for each word and partition with near words. See :func:`group_variants`."""
    sizes = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    level = words.select("word", "n", sizes.alias("size")).where("size > 0").withColumn("low", F.lit(0)).withColumn("high", F.col("size") + 1)
    level, done = _partitions(_halves(level)), None
    while True:
        # Partitions of one place hold at most one word for each symbol and pair of symbols, so they are never cut.
        large = level.where("high - low > 1").groupBy(F.xxhash64("key").alias("print")).count().where(F.col("count") > limit).select("print")
        large = stage(large, "spelling-large")
        if large.isEmpty():
            return _near(level if done is None else done.unionByName(level))
        marked = level.withColumn("print", F.when(F.expr("high - low > 1"), F.xxhash64("key")))
        small = marked.join(large, "print", "left_anti").drop("print").select(*level.columns)
        done = small if done is None else done.unionByName(small)
        level = _partitions(_halves(marked.join(large, "print", "left_semi").select("word", "n", "size", "low", "high")))


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root): the end of each word's chain of forms, by doubling the length of the steps each round."""
    ends = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if ends.join(further, "root", "left_semi").isEmpty():
            return ends
        ends = stage(ends.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def group_variants(words: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for a vocabulary of rows (word string, n long).

    Two words are near if one inserted, deleted or replaced code point makes one the other; ``n_near`` counts a word's near words. The
    ``form`` of a word is its near word of largest n (of equal ones the smallest in code-point order) if that n is at least twice the word's own,
    ``form_n``; else both are null. ``root`` is the last word of the chain of forms, the word itself if it has none.
    A word that stands in several rows counts once, with the sum of n; null and empty words and null counts are left out; other columns are
    dropped; no rows give no rows.

    The vocabulary is dealt into partitions that share an initial state of the acceptor: words with the same first half meet for edits in the second,
    words with the same second half for edits in the first. Each partition builds the minimised acceptor of what is left free,
    composes it with the transducer and itself, and enumerates the accepted pairs; a pair belongs to one partition, by
    its first difference. A partition of more than ``limit`` words is cut into two by the place of the edit, again and again, down
    to a single place, where an alphabet of k symbols leaves no more than k * (k + 1) words. Pairs are counted where they are found and never
    shuffled: a word has at most one near word for each place and symbol.
    """
    words = words.where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stage(words, "spelling-words")
    found = near_words(words, limit).select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")).alias("best"))
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"))
    every = own.unionByName(found, allowMissingColumns=True).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    good = -F.col("best.n") >= 2 * F.col("n")
    every = stage(every.select("word", "n", "n_near", F.when(good, F.col("best.word")).alias("form"), F.when(good, -F.col("best.n")).alias("form_n")), "spelling-forms")
    roots = _roots(every.where("form is not null"))
    return every.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
