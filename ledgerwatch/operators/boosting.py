"""Second-order boosting of binary trees over binned columns.

A column is cut into at most MAX_BINS bins at exact ranks, once. Every level of a tree is one aggregation of gradients and
hessians by (node, feature, bin); the sums are whole numbers, so they, and the trees, do not depend on how the rows are
split or in which order they come. What reaches the driver is one histogram per node, bounded by features x bins.

Rows are kept in blocks: one Spark row holds the bins, labels and margins of up to an Arrow batch of rows, a few bytes a value.
Tasks walk whole blocks down a tree and add them up by array arithmetic; Spark adds up the tasks. Blocks are dealt to as many tasks
as their rows are worth: a task of Python has a cost of its own, and a level of a tree is a job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import clean_double, is_finite
from ledgerwatch.operators import ordering, separation

MAX_BINS = 255
# Cells (node x feature x bin) of histograms that the driver holds at a time.
HELD_CELLS = 1 << 22
MOST_SHIFT = 30
LOSS_ROOM = 6
CHECKPOINT_TREES = 5
LEAST_GAIN = 1e-6
# Rows that a task walks: so many at least, as long as there are cores, and about so many at most.
LEAST_TASK_ROWS = 1 << 15
MOST_TASK_ROWS = 1 << 18
BLOCK = "bins binary, label binary, margin binary"
CELLS = "node int, feature int, bin int, g long, h long, n long"
LOSS_NODE = -1


@dataclass(frozen=True)
class Settings:
    """How trees are grown. `l2` is added to every hessian sum; a child needs a hessian sum of `min_child`."""

    max_trees: int = 50
    max_depth: int = 6
    step: float = 0.3
    l2: float = 1.0
    min_child: float = 1.0
    min_progress: float = 0.01
    n_bins: int = MAX_BINS


@dataclass(frozen=True)
class Node:
    """A node of a tree, numbered as in a heap: the children of n are 2n + 1 and 2n + 2. `feature` is -1 in a leaf.

    A value up to `threshold` goes left, as does a missing one if `missing_left`. `gain` is the loss reduction of the split,
    G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2); `cover` is the hessian sum H.
    """

    node: int
    gradient: float
    cover: float
    n_rows: int
    value: float
    feature: int = -1
    bin: int = -1
    threshold: float = 0.0
    missing_left: bool = False
    gain: float = 0.0


@dataclass(frozen=True)
class Binning:
    """Greatest finite value of every bin, for each feature. Bin 0 is for missing and infinite values, the others follow; one more
    is for values beyond all that the trees were trained on."""

    edges: tuple[tuple[float, ...], ...]

    @property
    def shape(self) -> tuple[int, int]:
        """Features, and the most bins of any of them."""
        return len(self.edges), 2 + max(1, *map(len, self.edges))

    def of(self, df: DataFrame, features: Sequence[str], **extra: Column) -> DataFrame:
        """`bins`, one small number per feature, beside the columns of `extra`."""
        names = [f"__v{i}" for i in range(len(features))]
        wide = df.select(*[v.alias(n) for n, v in extra.items()], *[clean_double(f).alias(n) for f, n in zip(features, names)])
        wide = wide.withColumns({n: F.when(is_finite(F.col(n)), F.col(n)) for n in names})
        splits = {n: [-math.inf, *[math.nextafter(e, math.inf) for e in own or (0.0,)], math.inf] for n, own in zip(names, self.edges)}
        binned = ordering.bucketize(wide, splits, {n: f"b{n}" for n in names})
        return binned.select(*extra, F.array(*[F.col(f"b{n}").cast("short") for n in names]).alias("bins"))


def find_bins(df: DataFrame, features: Sequence[str], label: str, n_bins: int = MAX_BINS) -> Binning:
    """Bins of about equal numbers of rows: a value lies in the bin of the rank of its first occurrence.

    Ranks are exact (`separation.value_counts`), so the bins are those of the data whatever its partitions. At most
    features x bins rows are collected.
    """
    counts = separation.value_counts(df, features, label)
    b = F.call_function("div", F.col("before_n_all") * n_bins, F.col("all_n_all")).alias("b")
    edges: list[list[float]] = [[] for _ in features]
    for row in counts.groupBy("fid", b).agg(F.max("value").alias("edge")).orderBy("fid", "b").collect():
        edges[row.fid].append(row.edge)
    return Binning(tuple(tuple(own) for own in edges))


@dataclass
class Tree:
    """A tree as arrays over heap numbers, for walking rows down it, and its nodes."""

    depth: int
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)
    levels: int = 0

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.bin, self.missing_left, self.value = [-1] * size, [0] * size, [False] * size, [0.0] * size

    def add(self, node: Node) -> None:
        self.nodes.append(node)
        self.feature[node.node], self.bin[node.node] = node.feature, node.bin
        self.missing_left[node.node], self.value[node.node] = node.missing_left, node.value
        if node.feature >= 0:
            self.levels = max(self.levels, (node.node + 1).bit_length())

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The nodes that rows have come to; `bins` has a line per feature."""
        feature, cut, left = np.array(self.feature), np.array(self.bin), np.array(self.missing_left)
        node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(self.levels):
            at = feature[node]
            own = bins[at, rows]
            goes_left = np.where(own == 0, left[node], own <= cut[node])
            node = np.where(at < 0, node, 2 * node + np.where(goes_left, 1, 2))
        return node


@dataclass(frozen=True)
class Fixed:
    """Whole-number sums: a weight of 1 counts 2^shift, with room for the sum over all rows in 63 bits."""

    shift: int
    weights: tuple[float, float]

    @classmethod
    def of(cls, n_rows: int, weights: tuple[float, float]) -> Fixed:
        room = 62 - max(1, n_rows).bit_length() - math.ceil(math.log2(max(1.0, *weights)))
        return cls(max(0, min(MOST_SHIFT, room)), weights)

    def weight(self, label: np.ndarray) -> np.ndarray:
        return np.where(label == 1, self.weights[1], self.weights[0])

    def whole(self, value: np.ndarray, spare: int = 0) -> np.ndarray:
        return np.floor(value * float(2 ** max(0, self.shift - spare)) + 0.5).astype(np.int64)


def blocks(binned: DataFrame) -> DataFrame:
    """Rows (bins, label) as blocks with margins of 0: a block is an Arrow batch of rows, its bins lie feature by feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if n:
                bins = batch.column(0).flatten().to_numpy().reshape(n, -1).astype(np.int16)
                label = batch.column(1).to_numpy().astype(np.int8)
                yield _block(bins.T, label, np.zeros(n))

    return binned.select("bins", "label").mapInArrow(run, BLOCK)


def _block(bins: np.ndarray, label: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary()) for part in (bins, label, margin)], names=["bins", "label", "margin"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, label, margin) of every block."""
    for batch in batches:
        for bins, label, margin in zip(*(batch.column(c) for c in ("bins", "label", "margin"))):
            own = np.frombuffer(label.as_buffer(), np.int8)
            yield np.frombuffer(bins.as_buffer(), np.int16).reshape(-1, len(own)), own, np.frombuffer(margin.as_buffer(), np.float64)


def _add(total: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """total[at] += values for whole numbers, without rounding."""
    if len(total) > 4 * len(at):
        np.add.at(total, at, values)
    elif len(at) and int(np.abs(values).max()) * len(at) < 1 << 53:
        total += np.bincount(at, values, len(total)).astype(np.int64)
    elif len(at):  # sums beyond the whole numbers that a double holds: the upper and the lower bits apart
        upper, lower = values >> 30, values & ((1 << 30) - 1)
        total += np.bincount(at, upper, len(total)).astype(np.int64) << 30
        total += np.bincount(at, lower, len(total)).astype(np.int64)


def _count(total: np.ndarray, place: np.ndarray, bins: np.ndarray, label: np.ndarray, margin: np.ndarray, fixed: Fixed) -> None:
    """Add rows to `total`, an array (feature, [gradient, hessian, rows], cell); the cells of a row are `place` and its bins."""
    p = 1.0 / (1.0 + np.exp(-margin))
    weight = fixed.weight(label)
    values = fixed.whole(weight * (p - label)), fixed.whole(weight * (p * (1.0 - p))), np.ones(len(label), np.int64)
    for own, sums in zip(bins, total):
        at = place + own
        for value, into in zip(values, sums):
            _add(into, at, value)


def _cells(total: np.ndarray, nodes: list[int], n_bins: int) -> pa.RecordBatch:
    """The cells of `total` that have rows; those of a node follow those of the node before it."""
    feature, cell = np.nonzero(total[:, 2])
    sums = [pa.array(total[feature, k, cell]) for k in range(3)]
    node = np.array(nodes, np.int32)[cell // n_bins]
    keys = [pa.array(k.astype(np.int32)) for k in (node, feature, cell % n_bins)]
    return pa.RecordBatch.from_arrays([*keys, *sums], names=["node", "feature", "bin", "g", "h", "n"])


def _added(cells: DataFrame) -> pa.Table:
    return cells.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toArrow()


def _dense(table: pa.Table, nodes: list[int], shape: tuple[int, int]) -> dict[int, np.ndarray]:
    node, feature, b = (table.column(c).to_numpy() for c in ("node", "feature", "bin"))
    out = {n: np.zeros((*shape, 3), np.int64) for n in nodes}
    for n in nodes:
        at = np.flatnonzero(node == n)
        for k, c in enumerate(("g", "h", "n")):
            out[n][feature[at], b[at], k] = table.column(c).to_numpy()[at]
    return out


def _histograms(rows: DataFrame, tree: Tree, wanted: list[int], fixed: Fixed, shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """For each wanted node an array (feature, bin, [gradient, hessian, rows]) of whole numbers."""
    slot = np.full(len(tree.feature), -1)
    slot[wanted] = np.arange(len(wanted))
    n_features, n_bins = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_features, 3, len(wanted) * n_bins), np.int64)
        for bins, label, margin in _opened(batches):
            place = slot[tree.place(bins)]
            here = np.flatnonzero(place >= 0)
            _count(total, place[here] * n_bins, bins[:, here], label[here], margin[here], fixed)
        yield _cells(total, wanted, n_bins)

    return _dense(_added(rows.select("bins", "label", "margin").mapInArrow(run, CELLS)), wanted, shape)


def _start(state: DataFrame, fixed: Fixed, shape: tuple[int, int]) -> tuple[int | None, np.ndarray]:
    """What a tree starts from, in one pass: the log loss of the validation rows in whole numbers, None without such rows, and the
    histogram of all training rows."""
    n_features, n_bins = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, losses = np.zeros((n_features, 3, n_bins), np.int64), []
        for batch in batches:
            for valid, (bins, label, margin) in zip(batch.column("valid"), _opened([batch])):
                if valid.as_py():
                    loss = np.log1p(np.exp(-np.abs(margin))) + np.maximum(margin, 0.0) - margin * label
                    losses.append(fixed.whole(fixed.weight(label) * loss, LOSS_ROOM).sum())
                else:
                    _count(total, np.zeros(len(label), np.int64), bins, label, margin, fixed)
        yield _cells(total, [0], n_bins)
        if losses:
            row = zip((LOSS_NODE, 0, 0, int(sum(losses)), 0, 0), (*[pa.int32()] * 3, *[pa.int64()] * 3))
            yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in row], names=["node", "feature", "bin", "g", "h", "n"])

    table = _added(state.mapInArrow(run, CELLS))
    losses = table.column("g").to_numpy()[table.column("node").to_numpy() == LOSS_NODE]
    return int(losses[0]) if len(losses) else None, _dense(table, [0], shape)[0]


def _moved(state: DataFrame, tree: Tree) -> DataFrame:
    """The blocks with the leaf value of each row added to its margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(tree.value)
        for batch in batches:
            opened = zip(batch.column("valid"), _opened([batch]))
            for valid, (bins, label, margin) in opened:
                block = _block(bins, label, margin + value[tree.place(bins)])
                yield block.append_column("valid", pa.array([valid.as_py()]))

    return state.mapInArrow(run, f"{BLOCK}, valid boolean")


def best_split(histogram: np.ndarray, unit: float, settings: Settings) -> tuple[float, int, int, bool] | None:
    """(gain, feature, bin, missing goes left) of the best split, or None. Ties: smallest feature, then bin, then missing right."""
    total = histogram[0].sum(axis=0)
    below = histogram[:, 1:].cumsum(axis=1)
    left = np.stack([below, below + histogram[:, :1]], axis=2)
    right = total - left
    g_left, h_left, g_right, h_right = left[..., 0] / unit, left[..., 1] / unit, right[..., 0] / unit, right[..., 1] / unit
    g, h = total[0] / unit, total[1] / unit
    fits = (left[..., 2] > 0) & (right[..., 2] > 0) & (h_left >= settings.min_child) & (h_right >= settings.min_child)
    gain = g_left * g_left / (h_left + settings.l2) + g_right * g_right / (h_right + settings.l2) - g * g / (h + settings.l2)
    gain = np.where(fits, gain, -np.inf)
    best = int(np.argmax(gain))
    if gain.flat[best] <= LEAST_GAIN:
        return None
    feature, b, side = np.unravel_index(best, gain.shape)
    return float(gain.flat[best]), int(feature), int(b) + 1, bool(side)


def grow(rows: DataFrame, binning: Binning, fixed: Fixed, settings: Settings, root: np.ndarray | None = None) -> Tree:
    """One tree on blocks of rows (bins, label, margin). `root` is the histogram of all rows, if that is known.

    Only the child with the smaller hessian sum is counted; its sibling is the parent's histogram less its own. Where a level
    has more cells than the driver holds, its nodes are counted in parts and each for itself, with the same sums.
    """
    tree, unit, shape = Tree(settings.max_depth), float(2**fixed.shift), binning.shape
    per_job = max(1, HELD_CELLS // (shape[0] * shape[1]))
    parents: dict[int, np.ndarray] = {}
    level, light = [0], {0}

    def node_of(node: int, sums: np.ndarray, **split) -> Node:
        g, h = sums[0] / unit, sums[1] / unit
        return Node(node, float(g), float(h), int(sums[2]), float(-settings.step * g / (h + settings.l2)), **split)

    while level:
        below: list[int] = []
        next_light: set[int] = set()
        whole_level = len(level) <= per_job
        kept: dict[int, np.ndarray] = {}
        for at in range(0, len(level), per_job):
            part = level[at : at + per_job]
            subtract = whole_level and bool(parents)
            counted = [n for n in part if n in light or not subtract]
            found = {0: root} if part == [0] and root is not None else _histograms(rows, tree, counted, fixed, shape)
            for node in part:
                if node not in found:
                    found[node] = parents[(node - 1) // 2] - found[node + 1 if node % 2 else node - 1]
            for node in part:
                histogram = found[node]
                sums = histogram[0].sum(axis=0)
                split = best_split(histogram, unit, settings)
                if split is None:
                    tree.add(node_of(node, sums))
                    continue
                gain, feature, b, missing_left = split
                left = histogram[feature, 1 : b + 1].sum(axis=0) + (histogram[feature, 0] if missing_left else 0)
                edge = binning.edges[feature][min(b, len(binning.edges[feature])) - 1]
                tree.add(node_of(node, sums, feature=feature, bin=b, threshold=edge, missing_left=missing_left, gain=gain))
                children = (2 * node + 1, 2 * node + 2)
                if children[0] + 1 >= 2**settings.max_depth:
                    for child, own in zip(children, (left, sums - left)):
                        tree.add(node_of(child, own))
                    continue
                below += children
                next_light.add(children[0] if 2 * left[1] <= sums[1] else children[1])
            if whole_level:
                kept = found
        level, light, parents = below, next_light, kept
    return tree


def n_tasks(spark: SparkSession, n_rows: int) -> int:
    """Tasks that rows are dealt to: one per core where that leaves them LEAST_TASK_ROWS, more where they would have over MOST_TASK_ROWS."""
    busy = min(spark.sparkContext.defaultParallelism, math.ceil(n_rows / LEAST_TASK_ROWS))
    return max(1, busy, math.ceil(n_rows / MOST_TASK_ROWS))


def fit(
    train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, weights: tuple[float, float], settings: Settings = Settings()
) -> tuple[list[Tree], Binning]:
    """Boosted trees, and the bins they were grown on, for the log loss of labels 0 and 1 (rows with another label take no part).

    Trees are grown until the validation loss gains less than `min_progress` of itself; without validation rows there are
    `max_trees`. The margins of all rows are kept with their bins, and their lineage is cut every CHECKPOINT_TREES trees. The pass
    that takes the loss after a tree also counts the root of the next.
    """
    known = F.col(label).cast("int")
    train, valid = (df.filter(known.isin(0, 1)) for df in (train, valid))
    binning = find_bins(train, features, label, settings.n_bins)
    parts = [blocks(binning.of(df, features, label=known)).withColumn("valid", F.lit(side)) for df, side in ((train, False), (valid, True))]
    n_rows = train.select(label).unionByName(valid.select(label)).count()
    state = parts[0].unionByName(parts[1]).repartition(n_tasks(train.sparkSession, n_rows)).persist()
    try:
        fixed = Fixed.of(n_rows, weights)
        trees: list[Tree] = []
        best, root = _start(state, fixed, binning.shape)
        for turn in range(1, settings.max_trees + 1):
            tree = grow(state.filter(~F.col("valid")), binning, fixed, settings, root)
            trees.append(tree)
            if not tree.levels:
                break
            moved = _moved(state, tree)
            moved = moved.checkpoint() if turn % CHECKPOINT_TREES == 0 else moved.persist()
            loss, root = _start(moved, fixed, binning.shape)
            state.unpersist()
            state = moved
            if best is not None and best - loss < settings.min_progress * best:
                break
            best = loss
        return trees, binning
    finally:
        state.unpersist()


def margins(trees: Sequence[Sequence[Node]], x: np.ndarray) -> np.ndarray:
    """Sum of the leaf values of each row; values that are not finite count as missing."""
    missing = ~np.isfinite(x)
    rows = np.arange(len(x))
    total = np.zeros(len(x))
    for nodes in trees:
        size = max(n.node for n in nodes) + 1
        feature, threshold, left, value = np.full(size, -1), np.zeros(size), np.zeros(size, bool), np.zeros(size)
        for n in nodes:
            feature[n.node], threshold[n.node], left[n.node], value[n.node] = n.feature, n.threshold, n.missing_left, n.value
        at = np.zeros(len(x), np.int64)
        while True:
            own = feature[at]
            inner = own >= 0
            if not inner.any():
                break
            goes_left = np.where(missing[rows, own], left[at], x[rows, own] <= threshold[at])
            at = np.where(inner, 2 * at + np.where(goes_left, 1, 2), at)
        total += value[at]
    return total
