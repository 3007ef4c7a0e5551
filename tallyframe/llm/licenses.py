"""License scan: fuzzy search for short notices in whole texts."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame

from tallyframe.llm.common import append_columns, words_of


@dataclass(frozen=True)
class Notice:
    """A phrase of lower-case words and the label it stands for. ``edits`` of None: one for each ten characters."""

    phrase: str
    label: str
    edits: int | None = None

    @property
    def most(self) -> int:
        return len(self.phrase) // 10 if self.edits is None else self.edits


#: The three phrases whose exact places are counted apart.
BASE = (
    Notice("under the mit license", "mit"),
    Notice("apache license version 2", "apache-2"),
    Notice("cc by nc", "cc-by-nc", 0),
)
NOTICES = BASE + (
    Notice("released under the mit license", "mit"),
    Notice("permission is hereby granted free of charge to any person", "mit"),
    Notice("licensed under the apache license version 2 0", "apache-2"),
    Notice("licensed under cc by nc", "cc-by-nc"),
    Notice("creative commons attribution noncommercial", "cc-by-nc"),
    Notice("gnu general public license version 3", "gpl-3"),
    Notice("gnu general public license version 2", "gpl-2"),
    Notice("gnu lesser general public license", "lgpl"),
    Notice("gnu affero general public license", "agpl"),
    Notice("mozilla public license", "mpl"),
    Notice("redistribution and use in source and binary forms", "bsd"),
    Notice("all rights reserved", "all-rights-reserved"),
)


class _Scanner:
    """Seeds of all notices in one automaton, and a bounded-error pattern for each notice.

    Pigeonhole: a place with at most k edits keeps one of k + 1 pieces of the phrase unchanged.
    """

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            n, parts = len(notice.phrase), notice.most + 1
            bounds = [n * p // parts for p in range(parts + 1)]
            for a, b in zip(bounds, bounds[1:]):
                seeds.setdefault(notice.phrase[a:b], []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(x.phrase)}){{e<={x.most}}}(?![^ ])") if x.most else None for x in notices
        ]

    def scan(self, words: list[bytes]) -> list[tuple[str, str, int, int, int]]:
        text = b" ".join(words).decode()
        exact: set[tuple[int, int]] = set()
        windows: dict[int, list[int]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            for i, offset in uses:
                start, phrase = end - size + 1 - offset, self.notices[i].phrase
                stop = start + len(phrase)
                if start >= 0 and text.startswith(phrase, start) and text[start - 1 : start] in ("", " ") and text[stop : stop + 1] in ("", " "):
                    exact.add((i, start))
                elif self.patterns[i] is not None:
                    windows.setdefault(i, []).append(start)
        found = [(i, start, start + len(self.notices[i].phrase), 0) for i, start in exact]
        for i, starts in windows.items():
            most, size = self.notices[i].most, len(self.notices[i].phrase)
            done = 0
            spans = sorted((s, s + size) for j, s in exact if j == i)
            for start in sorted(starts):
                low, high = max(done, start - most), start + size + most
                if low >= high:
                    continue
                low = text.rfind(" ", 0, max(low, 0) + 1) + 1
                high = text.find(" ", min(high, len(text)))
                high = len(text) if high < 0 else high
                for m in self.patterns[i].finditer(text, low, high, overlapped=False):
                    k = bisect_right(spans, (m.start(), len(text)))
                    if not (k and spans[k - 1][1] > m.start()) and not (k < len(spans) and spans[k][0] < m.end()):
                        found.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
                        done = m.end()
        if not found:
            return []
        found.sort(key=lambda f: f[1])
        borders = list(accumulate((len(w.decode()) + 1 for w in words), initial=0))  # where each word starts
        longest = max(f[2] - f[1] for f in found)
        places = set()
        for i, start, stop, edits in found:
            if edits:  # gives way to an overlapping place of fewer edits, as of another version of a license
                low = bisect_left(found, start - longest, key=lambda f: f[1])
                high = bisect_left(found, stop, key=lambda f: f[1])
                if any(f[3] < edits and f[2] > start for f in found[low:high]):
                    continue
            first, last = bisect_right(borders, start) - 1, bisect_right(borders, stop - 1) - 1
            places.add((self.notices[i].phrase, self.notices[i].label, first, last - first + 1, edits))
        return sorted(places, key=lambda p: (p[2], p[0], p[4]))


@lru_cache(maxsize=4)
def _scanner(notices: tuple[Notice, ...]) -> _Scanner:
    return _Scanner(notices)


def scan(df: DataFrame, text: str = "text", notices: Sequence[Notice] = NOTICES, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``n_words long`` and ``places array<struct<phrase, label, word, words, edits>>``.

    A place is where a notice stands in the words of the text, with up to its number of edits (inserted, lost or changed
    characters of the words joined by single spaces) between word borders; ``word`` counts from 0. Exact places
    are all reported, also overlapping ones; a place with edits gives way to an overlapping one with fewer.
    A null or empty text has 0 words and no places. Repeated rows are scanned each on its own. A text of any length is
    scanned whole. Columns named ``n_words`` or ``places`` are replaced.
    """
    notices = tuple(notices)

    def make(texts):
        tool = _scanner(notices)
        words = [words_of(t) for t in texts]
        rows = [[dict(zip(("phrase", "label", "word", "words", "edits"), p)) for p in tool.scan(w)] if w else [] for w in words]
        return [list(map(len, words)), rows]

    return append_columns(
        df, [text], "n_words long, places array<struct<phrase:string,label:string,word:bigint,words:bigint,edits:int>>", make, keep
    )
