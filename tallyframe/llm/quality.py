"""Quality classifier: a linear-chain conditional random field over the lines of a document."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import append_columns

#: Labelled documents that a fit reads at most, half of each label as far as there are, and the bytes of their texts.
FIT_DOCS, FIT_BYTES = 3000, 32 << 20
BAD, GOOD = 0, 1

_CLASSES = 8
_KIND = np.zeros(256, np.uint8)  # 0: other control
for _c in range(256):
    _ch = chr(_c)
    _KIND[_c] = (
        1 if _ch in " \t\r\x0b\x0c" else 2 if "a" <= _ch <= "z" or _c >= 128 else 3 if "A" <= _ch <= "Z" else 4 if "0" <= _ch <= "9"
        else 5 if _ch in ".,;:'\"()-?" else 6 if _ch == "!" else 7 if 32 < _c < 127 else 0
    )
_POWER = (np.uint64(0x9E3779B97F4A7C15) ** np.arange(256, dtype=np.uint64)).astype(np.uint64)
#: Line features: logarithm of length; shares of space, capitals, digits, points, exclamation and other signs; words by length; words
#: equal to the one before; lines of the document equal to this one; share of words in capitals at the start.
N_BASE = 11


def line_features(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all non-empty lines of the texts, their lengths in bytes, and the number of lines of each text."""
    raw = [(t or "").encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    doc_ends = np.cumsum(list(map(len, raw)))
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - starts
    fine = sizes > 0
    lines = np.searchsorted(doc_ends, ends, "right")
    per_doc = np.bincount(lines[fine], minlength=len(raw))
    starts, sizes, doc = starts[fine], sizes[fine], lines[fine]
    if not len(starts):
        return np.empty((0, N_BASE), np.float32), sizes, per_doc
    kinds = _KIND[data]
    shares = [np.zeros(len(starts))]
    for kind in range(1, _CLASSES):
        sums = np.concatenate([[0], np.cumsum(kinds == kind, dtype=np.int32)])
        shares.append((sums[starts + sizes] - sums[starts]) / sizes)
    # Words: runs that hold neither space nor line break.
    inside = (kinds != 1) & (data != 10)
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    same = np.zeros(len(begin))
    line_of = np.searchsorted(starts, begin, "right") - 1
    n_words = np.maximum(np.bincount(line_of, minlength=len(starts)), 1)
    if len(begin):
        length = stop - begin
        place = np.minimum(np.arange(len(data), dtype=np.int64)[inside] - np.repeat(begin, length), 255)
        hashes = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * _POWER[place], np.cumsum(length) - length)
        same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
        order = hashes * (np.arange(len(hashes), dtype=np.uint64) - np.repeat((np.cumsum(np.bincount(line_of, minlength=len(starts))) - np.bincount(line_of, minlength=len(starts))).astype(np.uint64), np.bincount(line_of, minlength=len(starts))) + np.uint64(1))
        line_hash = np.zeros(len(starts), np.uint64)
        np.add.at(line_hash, line_of, order)
    else:
        line_hash = np.zeros(len(starts), np.uint64)
    _, group, times = np.unique(line_hash ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_inverse=True, return_counts=True)
    repeats = np.bincount(line_of, weights=same, minlength=len(starts)) / n_words
    features = np.stack(
        [
            np.log1p(sizes) / 5, shares[1] * 4, np.minimum(shares[3] * 2, 1), np.minimum(shares[4] * 4, 1), np.minimum(shares[5] * 4, 1),
            np.minimum(shares[6] * 10, 1), np.minimum(shares[7] * 10, 1), np.minimum(sizes / n_words / 10, 2), np.minimum(repeats * 3, 1),
            np.minimum((times[group] - 1) / 3, 1), np.minimum(n_words / 10, 1),
        ],
        axis=1,
    )
    return features.astype(np.float32), sizes, per_doc


def features_of(texts: Sequence[str | None], chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`line_features` of many texts, about ``chunk`` characters at a time."""
    parts, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= chunk:
            parts.append(line_features(held))
            held, size = [], 0
    parts.append(line_features(held) if held else (np.empty((0, N_BASE), np.float32), np.empty(0, np.int64), np.empty(0, np.int64)))
    return tuple(np.concatenate(p) for p in zip(*parts))


def with_neighbours(features: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after in its document (zeros at the ends), and a constant."""
    n, width = features.shape
    out = np.zeros((n, 3 * width + 1), np.float32)
    out[:, :width], out[:, -1] = features, 1
    if n:
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        inner = np.flatnonzero(doc[1:] == doc[:-1])
        out[inner + 1, width : 2 * width] = features[inner]
        out[inner, 2 * width : 3 * width] = features[inner + 1]
    return out


def marginals(emission: np.ndarray, moves: np.ndarray, per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over all chains at once.

    ``emission``: per line the log-odds of good; ``moves[a, b]``: weight of a line of state b after one of state a. Returns
    the chance of good for each line, the expected number of each move, and the log of the partition functions' product.
    Chains are sorted by length, so that step t works on those that have a line t; work is the number of lines.
    """
    chains = np.flatnonzero(per_doc)
    order = chains[np.argsort(-per_doc[chains], kind="stable")]
    first = (np.cumsum(per_doc) - per_doc)[order]
    lengths = per_doc[order]
    longest = int(lengths[0]) if len(lengths) else 0
    scores = np.zeros((len(emission), 2))
    scores[:, GOOD] = emission
    forward = np.zeros((len(emission), 2))
    backward = np.zeros((len(emission), 2))
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]  # chains longer than t
    for t in range(longest):
        at = first[: active[t]] + t
        if t:
            before = forward[at - 1]
            for b in (BAD, GOOD):
                forward[at, b] = scores[at, b] + np.logaddexp(before[:, BAD] + moves[BAD, b], before[:, GOOD] + moves[GOOD, b])
        else:
            forward[at] = scores[at]
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        after = backward[at + 1] + scores[at + 1]
        for a in (BAD, GOOD):
            backward[at, a] = np.logaddexp(after[:, BAD] + moves[a, BAD], after[:, GOOD] + moves[a, GOOD])
    both = forward + backward
    total = np.logaddexp(both[:, BAD], both[:, GOOD])
    good = np.exp(both[:, GOOD] - total)
    expected = np.zeros((2, 2))
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    for a in (BAD, GOOD):
        for b in (BAD, GOOD):
            expected[a, b] = np.exp(forward[pair, a] + moves[a, b] + scores[pair + 1, b] + backward[pair + 1, b] - total[pair + 1]).sum()
    return good, expected, float(total[first].sum()) if len(first) else 0.0


@dataclass(frozen=True)
class Model:
    """Emission weights, move weights, and the line that turns a document's good share into a score.

    ``constant`` is set where the labels had one value only: every score is then that constant.
    """

    weights: np.ndarray
    moves: np.ndarray
    slope: float
    shift: float
    constant: float | None = None

    def good_share(self, texts: Sequence[str | None]) -> np.ndarray:
        """Length-weighted mean of the lines' chance to be good; 1 for texts without a line."""
        features, sizes, per_doc = features_of(texts)
        good, _, _ = marginals(with_neighbours(features, per_doc) @ self.weights, self.moves, per_doc)
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        weight = np.bincount(doc, weights=sizes, minlength=len(per_doc))
        return np.where(weight > 0, np.bincount(doc, weights=good * sizes, minlength=len(per_doc)) / np.maximum(weight, 1), 1.0)

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.good_share(texts) + self.shift, -500, 500)))


def _ascend(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Adam on a concave objective."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for i in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x += rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    return x


def fit_rows(texts: Sequence[str | None], labels: Sequence[int], steps: int = 200, penalty: float = 1e-5) -> Model:
    """Fit the field on labelled documents, whose lines have no labels of their own.

    First all lines take their document's label and a field without moves is fitted. Then lines of bad documents that
    this finds good become good, but for the worst line of each, and the whole field is fitted to these lines.
    At last a logistic line turns good shares into scores.
    """
    y = np.asarray(labels)
    n_pad = 3 * N_BASE + 1
    if len(y) == 0 or len(set(y.tolist())) < 2:
        return Model(np.zeros(n_pad), np.zeros((2, 2)), 0.0, 0.0, (float(y.sum()) + 1) / (len(y) + 2))
    features, _, per_doc = features_of(texts)
    x = with_neighbours(features, per_doc).astype(np.float64)
    doc = np.repeat(np.arange(len(y)), per_doc)
    line = y[doc].astype(np.float64)
    n = max(len(line), 1)

    def simple(w):
        return x.T @ (line - 1 / (1 + np.exp(-x @ w))) / n - penalty * w

    w = _ascend(simple, np.zeros(n_pad), steps, 0.2)
    good = 1 / (1 + np.exp(-x @ w))
    worst = np.full(len(y), np.inf)
    np.minimum.at(worst, doc, good)
    line = np.where((y[doc] == BAD) & (good > 0.5) & (good > worst[doc]), 1.0, line)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (line[pair].astype(int), line[pair + 1].astype(int)), 1)

    def whole(p):
        chance, expected, _ = marginals(x @ p[:n_pad], p[n_pad:].reshape(2, 2), per_doc)
        return np.concatenate([x.T @ (line - chance), (seen - expected).ravel()]) / n - penalty * p

    p = _ascend(whole, np.concatenate([w, np.zeros(4)]), steps, 0.1)
    model = Model(p[:n_pad], p[n_pad:].reshape(2, 2), 0.0, 0.0)
    share = np.stack([model.good_share(texts), np.ones(len(y))], 1)
    weight = np.where(y == GOOD, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))

    def line_fit(q):
        return share.T @ (weight * (y - 1 / (1 + np.exp(-share @ q)))) - 1e-4 * q

    q = _ascend(line_fit, np.array([10.0, -5.0]), 400, 0.2)
    return Model(model.weights, model.moves, float(max(q[0], 0)), float(q[1]))


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether a row is kept from training: CRC-32 of the id's text, modulo ``parts``, is ``part``. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_docs: int = FIT_DOCS, max_bytes: int = FIT_BYTES
) -> Model:
    """Fit on labelled documents outside the held-out part: at most ``max_docs`` rows and ``max_bytes`` of text.

    The sample is drawn by a hash of the id, half from each label as far as there are, and whole texts are taken
    until the bytes are used up. Null ids and null labels are left out; an id with several labels counts once, with the smallest; rows that
    repeat an id are all read. Without rows of both labels every score is one constant, (rows of label 1 + 1) / (rows + 2).
    """
    known = labels.select(labels[doc_id].cast("long").alias("id"), labels[label].cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    draw = F.xxhash64("id", F.lit("fit"))
    picked = [r for y in (BAD, GOOD) for r in known.where(F.col("y") == y).orderBy(draw, "id").limit(max_docs // 2).collect()]
    spark = docs.sparkSession
    if not picked:
        return fit_rows([], [])
    few = spark.createDataFrame([(r["id"], r["y"]) for r in picked], "id long, y int")
    found = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("t")).join(F.broadcast(few), "id").where("t is not null")
    # The broadcast side and the rows collected here are bounded by max_docs and max_bytes.
    sized = found.select("id", F.octet_length("t").alias("n")).orderBy(draw, "id", "n").limit(2 * max_docs).collect()
    room, ids = max_bytes, set()
    for r in sized:
        if r["id"] not in ids and r["n"] <= room:
            ids.add(r["id"])
            room -= r["n"]
    chosen = spark.createDataFrame([(i,) for i in sorted(ids)], "id long") if ids else None
    rows = found.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("t").alias("t"), F.min("y").alias("y")).orderBy("id").collect() if ids else []
    return fit_rows([r["t"] for r in rows], [r["y"] for r in rows])


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score double``, from 0 to 1, higher where good text is likelier.

    Uses the text alone, the whole of it. A null or empty text has no bad line and gets the score of a
    wholly good text. Repeated rows score alike. A column named ``score`` is replaced.
    """
    return append_columns(df, [text], "score double", lambda texts: [model.score(texts).tolist()], keep, chunk=1 << 20)
