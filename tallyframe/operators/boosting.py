"""Second-order gradient boosting: trees grown by grouped sums of gradients and hessians, as an MLlib model.

MLlib's own boosting fits each tree to first-order residuals. Here a split is chosen by the gain of the second-order
expansion of the log loss and a leaf takes the Newton step, both with an L2 penalty, and rows and columns are drawn once for each
tree. The fitted trees are handed to MLlib as a ``GBTClassificationModel``, which scores, explains and saves them.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.encode import FEATURES, KEY, NUMBERS, SLOTS
from tallyframe.operators.order import quantiles
from tallyframe.session import checkpoint_dir, stage

#: Trees after which the margins of the kept rows are brought up to date, and after which these rows are written, so that plans stay short
#: and a lost executor costs few trees.
FOLD, CUT = 4, 16
#: A feature and a bin as one number; a bin is less than this.
BINS = 256
#: Rows of a part, and sums that a task holds before it adds them up.
PART_ROWS, HELD = 100_000, 2_000_000
#: Sums (of all nodes, features and bins) up to which a task adds up in place instead of sorting keys.
DENSE = 1 << 18
#: Bits of a feature and bin below the node in a key.
_NODE = 44
_DRAW = 1_000_000
NODES = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,"
    "rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


@dataclass
class Node:
    """Sums of a node's rows and, if it is split, the lowest (feature, bin) of its right side, the gain and the children."""

    gradient: float
    hessian: float
    rows: int
    code: int | None = None
    gain: float = 0.0
    children: list[Node] = field(default_factory=list)

    def value(self, penalty: float) -> float:
        """The Newton step of the node's rows."""
        return -self.gradient / (self.hessian + penalty)


@dataclass(frozen=True)
class Grown:
    """Fitted trees with the cut points of each numeric feature, and the number of features."""

    trees: tuple[Node, ...]
    cuts: tuple[tuple[float, ...], ...]
    width: int


def _condition(code: int, numbers: int) -> str:
    feature, least = divmod(code, BINS)
    return f"bins[{feature}] >= {least}" if feature < numbers else f"array_contains(entries, {code}L)"


def _place(node: Node, depth: int, numbers: int, at: int = 0) -> str:
    """SQL for the place of a row among the nodes of a depth, null where its branch ended before."""
    if depth == 0:
        return str(at)
    if node.code is None:
        return "cast(null as int)"
    left, right = (_place(c, depth - 1, numbers, 2 * at + i) for i, c in enumerate(node.children))
    return f"case when {_condition(node.code, numbers)} then {right} else {left} end"


def _step(node: Node, numbers: int, rate: float, penalty: float) -> str:
    """SQL for what the tree adds to a row's margin."""
    if node.code is None:
        return f"{rate * node.value(penalty)!r}D"
    left, right = (_step(c, numbers, rate, penalty) for c in node.children)
    return f"case when {_condition(node.code, numbers)} then {right} else {left} end"


def _at_depth(node: Node, depth: int) -> list[Node | None]:
    """Nodes of a depth by place, ``None`` where there is none."""
    if depth == 0:
        return [node]
    return [n for c in node.children for n in _at_depth(c, depth - 1)] if node.children else [None] * 2**depth


@dataclass(frozen=True)
class SecondOrderBoosting:
    """Settings of the boosting; ``fit`` needs rows from :meth:`Encoder.transform` with ``parts=True``.

    ``share`` and ``columns`` are the shares of rows and of columns that each tree sees, drawn by hashes of the row's key and the
    column, so a model does not depend on how rows lie on the cluster. Numeric columns are cut at ``bins`` quantiles (a sketch's, or with
    ``exact`` exact ones); a category is a feature that a row has or has not. A split leaves at least ``least`` of hessian on each side.
    """

    rounds: int = 300
    depth: int = 5
    rate: float = 0.05
    share: float = 0.9
    columns: float = 0.9
    penalty: float = 1.0
    least: float = 1.0
    bins: int = BINS
    exact: bool = False
    seed: int = 42
    label: str = "label"
    weight: str | None = None

    def fit(self, rows: DataFrame) -> GBTClassificationModel:
        return to_mllib(rows.sparkSession, self.grow(rows), self.rate, self.penalty, self.label)

    def grow(self, rows: DataFrame) -> Grown:
        """The trees. For each level of a tree one grouped sum over (node, feature, bin), combined in each task before the shuffle.

        Only features that a row has are summed; the lowest bin of a number, and rows without a category, are the node's
        sum less theirs. All sums of a feature meet in one task, which finds its best split of each node by running sums over the bins, so that
        the driver receives one row for each node and task, whatever the number of features.
        """
        first = rows.select(FEATURES, F.size(NUMBERS).alias("numbers")).first()
        if first is None:
            raise ValueError("no rows to fit on")
        width, numbers = first[FEATURES].size, first["numbers"]
        cuts = self._cuts(rows, numbers)
        binned = self._binned(rows, cuts).withColumn("m", F.lit(0.0)).coalesce(rows.count() // PART_ROWS + 1)
        base, last = binned.persist(StorageLevel.DISK_ONLY), None
        trees: list[Node] = []
        folded = 0  # trees that the margins of the kept rows hold; later ones are added as the rows are read
        for tree in range(self.rounds):
            steps = [f"({_step(t, numbers, self.rate, self.penalty)})" for t in trees[folded:]]
            state = base.withColumn("m", F.expr(" + ".join(["m", *steps])))
            if len(steps) == FOLD:
                last, folded = base, tree
                base = (stage(state, "boosting-rows") if tree % CUT == 0 else state).persist(StorageLevel.DISK_ONLY)
                state = base
            root = self._root(state, tree)
            if last is not None:
                last.unpersist()  # the root's sums have read the rows made of it
                last = None
            trees.append(self._grown(state, tree, root, numbers, width))
        base.unpersist()
        return Grown(tuple(trees), cuts, width)

    def _cuts(self, rows: DataFrame, numbers: int) -> tuple[tuple[float, ...], ...]:
        keys = {str(j): F.col(NUMBERS)[j] for j in range(numbers)}
        found = quantiles(rows, keys, [i / self.bins for i in range(1, self.bins)], exact=self.exact)
        return tuple(tuple(sorted({c for c in found[str(j)] if c is not None})) for j in range(numbers))

    def _binned(self, rows: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
        """Rows (key, y, w, bins, entries): the bin of each number, and codes of all that is above a feature's lowest bin."""
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        raw = rows.select(
            F.col(KEY).alias("key"), F.col(self.label).cast("double").alias("y"), weight.alias("w"), SLOTS, *[F.col(NUMBERS)[j].alias(f"x{j}") for j in range(len(cuts))]
        )
        cut = [j for j, c in enumerate(cuts) if c]
        if cut:
            splits = [[-math.inf, *cuts[j], math.inf] for j in cut]
            raw = Bucketizer(splitsArray=splits, inputCols=[f"x{j}" for j in cut], outputCols=[f"b{j}" for j in cut]).transform(raw)
        bins = [F.col(f"b{j}").cast("int") if c else F.lit(0) for j, c in enumerate(cuts)]
        above = [F.when(b > 0, F.lit(j * BINS).cast("long") + b) for j, b in enumerate(bins)]
        has = F.transform(SLOTS, lambda s: (s.cast("long") + len(cuts)) * BINS + 1)
        entries = F.concat(F.array_compact(F.array(*above).cast("array<bigint>")), has)
        return raw.select("key", "y", "w", F.array(*bins).cast("array<int>").alias("bins"), entries.alias("entries"))

    def _sums(self, state: DataFrame, tree: int) -> DataFrame:
        """Gradient and hessian of the rows that the tree draws."""
        drawn = state if self.share >= 1 else state.where(F.expr(f"pmod(xxhash64(key, {self.seed}, {tree}), {_DRAW}) < {self.share * _DRAW!r}D"))
        chance = "1D / (1D + exp(-m))"
        return drawn.selectExpr(f"w * ({chance} - y) as g", f"w * ({chance}) * (1D - {chance}) as h", "bins", "entries")

    def _root(self, state: DataFrame, tree: int) -> Node:
        total = self._sums(state, tree).agg(F.sum("g"), F.sum("h"), F.count("*")).first()
        return Node(total[0] or 0.0, total[1] or 0.0, total[2])

    def _grown(self, state: DataFrame, tree: int, root: Node, numbers: int, width: int) -> Node:
        sums = self._sums(state, tree)
        for depth in range(self.depth):
            nodes = _at_depth(root, depth)
            if not any(n is not None and n.hessian >= 2 * self.least for n in nodes):
                break
            for place, (gain, code, g, h, n) in self._best(sums, _place(root, depth, numbers), nodes, tree, numbers, width).items():
                node, right = nodes[place], Node(g, h, n)
                node.code, node.gain = code, gain
                node.children = [Node(node.gradient - right.gradient, node.hessian - right.hessian, node.rows - right.rows), right]
        return root

    def _best(self, sums: DataFrame, place: str, nodes: Sequence[Node | None], tree: int, numbers: int, width: int) -> dict[int, tuple]:
        """For each node its best split (gain, code, sums and rows of the right side); of equal gains the lowest feature and bin."""
        flat = sums.selectExpr(f"{place} as node", "g", "h", "entries").where("node is not null")
        many = len(nodes)

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _histograms(batches, many, numbers, width)

        held = flat.mapInArrow(histograms, "node int, feature long, code long, g double, h double, n long")
        if self.columns < 1:
            held = held.where(F.expr(f"pmod(xxhash64(feature, {self.seed}, {tree}, 'column'), {_DRAW}) < {self.columns * _DRAW!r}D"))
        known = np.array([(0.0, 0.0) if n is None else (n.gradient, n.hessian) for n in nodes])
        penalty, least = self.penalty, self.least

        def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _splits(batches, known, numbers, penalty, least)

        best: dict[int, tuple] = {}
        # One row for each node and task.
        for row in held.repartition("node", "feature").mapInArrow(splits, "node int, gain double, code long, g double, h double, n long").collect():
            if row["node"] not in best or (-row["gain"], row["code"]) < (-best[row["node"]][0], best[row["node"]][1]):
                best[row["node"]] = tuple(row)[1:]
        return best


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Keys in order, with the sums of g, h and n of each."""
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *(np.bincount(at, np.concatenate([p[k] for p in parts]), len(keys)) for k in (1, 2, 3))


def _histograms(batches: Iterator[pa.RecordBatch], nodes: int, numbers: int, width: int) -> Iterator[pa.RecordBatch]:
    """Sums of the rows (node, g, h, entries) of one task by node and entry."""
    low = numbers * BINS  # codes of numbers lie below it; a category has one code
    cells = low + width - numbers
    dense = nodes * cells <= DENSE
    parts: list[tuple[np.ndarray, ...]] = []
    sums = np.zeros((3, nodes * cells)) if dense else None
    for batch in batches:
        if not batch.num_rows:
            continue
        node, g, h = (batch.column(i).to_numpy() for i in range(3))
        times, codes = pc.list_value_length(batch.column(3)).to_numpy(), batch.column(3).flatten().to_numpy()
        if dense:
            at = np.repeat(node.astype(np.int64) * cells, times) + np.where(codes < low, codes, codes // BINS + (low - numbers))
            for total, weights in zip(sums, (np.repeat(g, times), np.repeat(h, times), None)):
                total += np.bincount(at, weights, nodes * cells)
            continue
        keys = np.repeat(node.astype(np.int64) << _NODE, times) | codes
        parts.append(_summed([(keys, np.repeat(g, times), np.repeat(h, times), np.ones(len(keys)))]))
        if sum(len(p[0]) for p in parts) > HELD:
            parts = [_summed(parts)]
    if dense:
        at = np.flatnonzero(sums[2])
        node, cell = np.divmod(at, cells)
        parts = [(node << _NODE | np.where(cell < low, cell, (cell - low + numbers) * BINS + 1), *sums[:, at])] if len(at) else []
    if parts:
        keys, g, h, n = parts[0] if dense else _summed(parts)
        code = keys & ((1 << _NODE) - 1)
        for a in range(0, len(keys), 100_000):
            part = slice(a, a + 100_000)
            columns = [(keys[part] >> _NODE).astype(np.int32), code[part] // BINS, code[part], g[part], h[part], n[part].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "feature", "code", "g", "h", "n"])


def _splits(batches: Iterator[pa.RecordBatch], known: np.ndarray, numbers: int, penalty: float, least: float) -> Iterator[pa.RecordBatch]:
    """The best split of each node among the features of one task; ``known`` holds the sums of each node."""
    parts = []
    for batch in batches:
        node, code, g, h, n = (batch.column(i).to_numpy() for i in (0, 2, 3, 4, 5))
        if len(node):
            parts.append((node.astype(np.int64) << _NODE | code, g, h, n))
    if not parts:
        return
    keys, *sums = _summed(parts)
    node, code = keys >> _NODE, keys & ((1 << _NODE) - 1)
    # The right side of a split at a bin: this bin and those above it. A category has one bin.
    many = np.flatnonzero(code < numbers * BINS)
    for group in np.split(many, np.flatnonzero(np.diff(keys[many] // BINS)) + 1) if len(many) else []:
        for x in sums:
            x[group] = np.cumsum(x[group][::-1])[::-1]
    g, h, n = sums
    left_g, left_h = known[node, 0] - g, known[node, 1] - h
    fine = (h >= least) & (left_h >= least)
    with np.errstate(all="ignore"):
        gain = left_g * left_g / (left_h + penalty) + g * g / (h + penalty) - known[node, 0] * known[node, 0] / (known[node, 1] + penalty)
    order = np.lexsort((code, -gain))
    order = order[(fine & (gain > 1e-6))[order]]
    _, first = np.unique(node[order], return_index=True)
    at = order[first]
    columns = [node[at].astype(np.int32), gain[at], code[at], g[at], h[at], n[at].astype(np.int64)]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "gain", "code", "g", "h", "n"])


def _numbered(node: Node, tree: int, grown: Grown, rate: float, penalty: float, rows: list[tuple]) -> int:
    """Append the node and those below it in MLlib's form, numbered from the root down and from left to right."""
    at = len(rows)
    rows.append(())
    value = rate * node.value(penalty) / 2  # MLlib's chance is 1 / (1 + exp(-2 * margin))
    stats, children, split = [float(node.rows), node.rows * value, node.rows * value * value], (-1, -1), (-1, [], -1)
    if node.code is not None:
        feature, least = divmod(node.code, BINS)
        # MLlib sends values up to the threshold to the left; ours below a cut.
        threshold = math.nextafter(grown.cuts[feature][least - 1], -math.inf) if feature < len(grown.cuts) else 0.5
        split, children = (feature, [threshold], -1), tuple(_numbered(c, tree, grown, rate, penalty, rows) for c in node.children)
    gain = node.gain / max(node.rows, 1) if node.code is not None else -1.0
    rows[at] = (tree, (at, value, 0.0, stats, node.rows, gain, *children, split))
    return at


def to_mllib(spark: SparkSession, grown: Grown, rate: float, penalty: float, label: str = "label") -> GBTClassificationModel:
    """The trees as MLlib's boosted model, by writing its saved form to the shared folder and loading that.

    The share of gain is a feature's importance in each tree.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/boosting-model-{uuid.uuid4().hex}"
    rows: list[tuple] = []
    for i, root in enumerate(grown.trees):
        nodes: list[tuple] = []
        _numbered(root, i, grown, rate, penalty, nodes)
        rows += nodes
    depth = max(1, max(map(_depth, grown.trees)))
    about = {"timestamp": 0, "sparkVersion": spark.version, "defaultParamMap": {"impurity": "variance"}}
    tree = {**about, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": {"featuresCol": FEATURES, "labelCol": label, "maxDepth": depth}}
    whole = {
        **about, "class": "org.apache.spark.ml.classification.GBTClassificationModel", "uid": f"second_order_boosting_{uuid.uuid4().hex[:12]}",
        "paramMap": {"featuresCol": FEATURES, "labelCol": label, "maxDepth": depth, "maxIter": len(grown.trees), "stepSize": rate},
        "numFeatures": grown.width, "numTrees": len(grown.trees),
    }
    spark.createDataFrame(rows, NODES).coalesce(1).write.parquet(f"{path}/data")
    trees = [(i, json.dumps({**tree, "uid": f"tree_{i}"}), 1.0) for i in range(len(grown.trees))]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTClassificationModel.load(path)


def _depth(node: Node) -> int:
    return 1 + max(map(_depth, node.children)) if node.children else 0
