"""Boosted trees of second order over histograms, continued from a stored margin.

Features are cut into bins once; edges come from a quantile sketch. A level of a tree needs one
aggregate: sums of gradients and hessians per (node, feature, bin), added up within each
partition first, so what is shuffled and what reaches the driver depends on the tree and the
bins, not on the rows. Trees of finished rounds are replayed on the rows of a partition;
every ``FOLD`` rounds margins are written anew. Gradients are whole numbers (of 1 / ``SCALE``),
so sums, and with them the trees, do not depend on how rows are spread.

A table of at most ``ONE_TASK_ROWS`` rows is one partition: its own sums are the sums, all
rounds run in one task and no level needs a job. The trees are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path, settle


@dataclass(frozen=True)
class BoostingParams:
    # Defaults of the fraud model.
    rounds: int = 400
    learning_rate: float = 0.05
    depth: int = 6
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    l2: float = 1.0
    #: Least sum of hessians in a child.
    min_child: float = 1.0
    bins: int = 128


#: Gradients count in steps of this fraction.
SCALE = 1 << 20
#: Rounds after which margins are written, so that a level replays no more trees.
FOLD = 10
#: Rows up to which one task runs all rounds by itself.
ONE_TASK_ROWS = 50_000
#: Gains below this are rounding.
_LEAST_GAIN = 1e-6

TREE_SCHEMA = ("tree int, node int, feature int, threshold double, missing_left boolean, "
               "value double, gain double, cover double")

_NODE = ["feature", "threshold", "missing_left", "value", "gain", "cover"]


@dataclass
class Tree:
    """Nodes in heap order; ``feature`` is -1 at leaves. A row goes left if its value is at most
    the threshold, or is missing and ``missing_left`` says so."""

    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    #: The bin that the threshold ends; only while training.
    cut: np.ndarray = field(repr=False, default=None)

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n),
                   np.zeros(n), np.zeros(n, np.int32))

    def margin(self, values: np.ndarray) -> np.ndarray:
        """The leaf value of each row of a matrix of feature values."""
        node, rows = np.zeros(len(values), np.int64), np.arange(len(values))
        for _ in range(int(np.log2(len(self.feature) + 1)) - 1):
            own = self.feature[node]
            if (own < 0).all():
                break
            x = values[rows, np.maximum(own, 0)]
            left = np.where(np.isnan(x), self.missing_left[node], x <= self.threshold[node])
            node = np.where(own >= 0, 2 * node + 2 - left, node)
        return self.value[node]

    def table(self, number: int) -> pa.RecordBatch:
        """The nodes that rows can reach, as rows of ``TREE_SCHEMA``."""
        at = np.flatnonzero(self.cover > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), number, np.int32)), pa.array(at.astype(np.int32)),
             *[pa.array(getattr(self, name)[at]) for name in _NODE]], ["tree", "node", *_NODE])

    def rows(self, number: int) -> Iterator[tuple]:
        return zip(*(c.to_pylist() for c in self.table(number).columns))


def trees_of(rows) -> list[Tree]:
    """Trees from the rows of ``TREE_SCHEMA``."""
    by_tree: dict[int, list] = {}
    for row in rows:
        by_tree.setdefault(row[0], []).append(row)
    out = []
    for number in sorted(by_tree):
        nodes = by_tree[number]
        tree = Tree.empty(int(np.log2(max(r[1] for r in nodes) + 1)))
        for _, i, *values in nodes:
            for name, value in zip(_NODE, values):
                getattr(tree, name)[i] = value
        out.append(tree)
    return out


class Layout:
    """Cells of a histogram: per feature its bins, one more than it has edges, then missing."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.widths = np.array([len(e) + 2 for e in edges], np.int64)
        self.offsets = np.append(0, np.cumsum(self.widths))
        self.cells = int(self.offsets[-1])

    def binned(self, values: np.ndarray) -> np.ndarray:
        """Bin numbers as ``uint16``: how many edges are below the value."""
        out = np.empty(values.shape, np.uint16)
        for f, edges in enumerate(self.edges):
            column = values[:, f]
            out[:, f] = np.where(np.isnan(column), len(edges) + 1, np.searchsorted(edges, column))
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of unsigned 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Part:
    """Binned rows of a task, with their margins."""

    def __init__(self, batch: pa.RecordBatch, layout: Layout):
        self.missing = layout.widths - 1
        raw = b"".join(batch.column("bins").to_pylist())
        self.bins = np.frombuffer(raw, np.uint16).reshape(-1, len(layout.edges))
        self.label, self.weight, margin = (np.asarray(batch.column(c)) for c in ("label", "weight", "margin"))
        self.margin = margin.copy()
        self.draw = np.asarray(batch.column("draw")).view(np.uint64)

    def begin(self, number: int, params: BoostingParams) -> None:
        """Gradients of round ``number``; rows that it does not draw have none."""
        key = np.uint64((params.seed * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % (1 << 64))
        drawn = (_mixed(_mixed(self.draw ^ key)) >> np.uint64(11)) * 2.0 ** -53 < params.row_share
        self.at = np.flatnonzero(drawn)
        p = 1 / (1 + np.exp(-self.margin[self.at]))
        weight, label = self.weight[self.at], self.label[self.at]
        self.g = np.rint(weight * (p - label) * SCALE)
        self.h = np.rint(np.maximum(weight * p * (1 - p), 1e-16) * SCALE)
        self.node = np.zeros(len(self.at), np.int64)

    def sums(self, level: int, columns: np.ndarray, layout: Layout) -> np.ndarray:
        """Whole sums (gradient, hessian) per node of the level and cell."""
        first, cells = 2 ** level - 1, layout.cells
        own = np.flatnonzero(self.node >= first)
        out = np.zeros((2, 2 ** level * cells), np.int64)
        base = (self.node[own] - first) * cells
        for f in columns.tolist():
            cell = base + layout.offsets[f] + self.bins[self.at[own], f]
            for k, values in enumerate((self.g, self.h)):
                found = np.bincount(cell, values[own], minlength=1)
                out[k, :len(found)] += found.astype(np.int64)
        return out.reshape(2, 2 ** level, cells)

    def descend(self, tree: Tree, level: int) -> None:
        own = np.flatnonzero(self.node >= 2 ** level - 1)
        own = own[tree.feature[self.node[own]] >= 0]
        self.node[own] = _child(tree, self.node[own], self.bins[self.at[own]], self.missing)

    def replay(self, tree: Tree) -> None:
        """Add a finished tree to the margins of all rows."""
        node = np.zeros(len(self.bins), np.int64)
        while True:
            own = np.flatnonzero(tree.feature[node] >= 0)
            if not len(own):
                break
            node[own] = _child(tree, node[own], self.bins[own], self.missing)
        self.margin += tree.value[node]


def _child(tree: Tree, node: np.ndarray, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
    feature = tree.feature[node]
    x = bins[np.arange(len(node)), feature]
    left = np.where(x == missing[feature], tree.missing_left[node], x <= tree.cut[node])
    return 2 * node + 2 - left


def drawn_columns(number: int, features: int, params: BoostingParams) -> np.ndarray:
    """The columns of round ``number``, in order."""
    n = max(1, int(params.column_share * features))
    return np.sort(np.random.default_rng([params.seed, number]).permutation(features)[:n])


def split_level(tree: Tree, level: int, sums: np.ndarray, columns: np.ndarray, layout: Layout,
                params: BoostingParams) -> bool:
    """Split the nodes of a level at their best cut; whether any was split.

    The first of equal gains is taken: lowest column, lowest cut, missing values right.
    """
    first, nodes = 2 ** level - 1, 2 ** level
    g, h = sums / SCALE
    begin, end = layout.offsets[columns[0]], layout.offsets[columns[0] + 1]
    total_g, total_h = g[:, begin:end].sum(1), h[:, begin:end].sum(1)
    if level == 0:
        _set_value(tree, 0, total_g[0], total_h[0], params)
    best = np.full(nodes, _LEAST_GAIN)
    choice = [None] * nodes
    for f in columns.tolist():
        begin, k = layout.offsets[f], len(layout.edges[f])
        if not k:
            continue
        for missing in (False, True):
            left_g, left_h = (x[:, begin:begin + k].cumsum(1) for x in (g, h))
            if missing:
                left_g = left_g + g[:, begin + k + 1, None]
                left_h = left_h + h[:, begin + k + 1, None]
            right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
            gain = (left_g ** 2 / (left_h + params.l2) + right_g ** 2 / (right_h + params.l2)
                    - (total_g ** 2 / (total_h + params.l2))[:, None]) / 2
            gain[(left_h < params.min_child) | (right_h < params.min_child)] = -1
            at = gain.argmax(1)
            top = gain[np.arange(nodes), at]
            for j in np.flatnonzero(top > best).tolist():
                best[j] = top[j]
                choice[j] = (f, int(at[j]), missing, left_g[j, at[j]], left_h[j, at[j]])
    for j, found in enumerate(choice):
        if found is None:
            continue
        node, (f, cut, missing, left_g, left_h) = first + j, found
        tree.feature[node], tree.cut[node], tree.missing_left[node] = f, cut, missing
        tree.threshold[node], tree.gain[node] = layout.edges[f][cut], best[j]
        _set_value(tree, 2 * node + 1, left_g, left_h, params)
        _set_value(tree, 2 * node + 2, total_g[j] - left_g, total_h[j] - left_h, params)
    return any(choice)


def _set_value(tree, node, g, h, params):
    tree.value[node] = -g / (h + params.l2) * params.learning_rate
    tree.cover[node] = h


def grow(sums_of: Callable[[Tree, int, np.ndarray], np.ndarray], number: int, layout: Layout,
         params: BoostingParams) -> Tree:
    """The tree of a round; ``sums_of`` gives the sums of a level of it."""
    tree, columns = Tree.empty(params.depth), drawn_columns(number, len(layout.edges), params)
    for level in range(params.depth):
        if not split_level(tree, level, sums_of(tree, level, columns), columns, layout, params):
            break
    return tree


def quantile_edges(rows: DataFrame, features: int, column: str = "features",
                   bins: int = BoostingParams.bins, accuracy: int = 10_000) -> list[np.ndarray]:
    """Per feature up to ``bins`` - 1 distinct edges: quantiles of its values, in one aggregate."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])

    def sketch(i):
        value = F.col(column)[i]
        return F.percentile_approx(F.when(~F.isnan(value), value), shares, accuracy).alias(f"q{i}")

    found = rows.agg(*[sketch(i) for i in range(features)], *[
        F.max(F.when(~F.isnan(F.col(column)[i]), F.col(column)[i])).alias(f"m{i}")
        for i in range(features)]).first()
    out = []
    for i in range(features):
        edges = np.unique(np.array(found[f"q{i}"] or [], np.float64))
        out.append(edges[edges < found[f"m{i}"]] if len(edges) else edges)
    return out


_PREPARED = "bins binary, label double, weight double, margin double, draw bigint"


def _prepared(rows: DataFrame, layout: Layout, column: str, label: str, weight: str,
              margin: str | None) -> DataFrame:
    """Rows (bins, label, weight, margin, draw), settled."""
    place = F.monotonically_increasing_id()
    start = F.col(margin).cast("double") if margin else F.lit(0.0)
    given = rows.select(F.col(column).alias("features"), F.col(label).cast("double").alias("label"),
                        F.col(weight).cast("double").alias("weight"), start.alias("margin"),
                        F.xxhash64(place).alias("draw"))

    def cut(batches):
        for batch in batches:
            values = np.asarray(batch.column(0).flatten()).reshape(-1, len(layout.edges))
            raw = layout.binned(values)
            bins = pa.array([r.tobytes() for r in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([bins, *batch.columns[1:]],
                                             ["bins", "label", "weight", "margin", "draw"])

    path = scratch_path(rows.sparkSession, "binned")
    given.mapInArrow(cut, _PREPARED).write.parquet(path)
    return rows.sparkSession.read.schema(_PREPARED).parquet(path)


def _in_one_task(prepared: DataFrame, layout: Layout, params: BoostingParams, first: int) -> list[Tree]:
    def run(batches):
        batches = list(batches)
        if not batches:
            return
        part = Part(pa.Table.from_batches(batches).combine_chunks().to_batches()[0], layout)

        def sums(tree, level, columns):
            if level:
                part.descend(tree, level - 1)
            return part.sums(level, columns, layout)

        for number in range(first, first + params.rounds):
            part.begin(number, params)
            tree = grow(sums, number, layout, params)
            part.replay(tree)
            yield tree.table(number)

    # Bounded by ONE_TASK_ROWS in, and by the rounds out.
    return trees_of(prepared.coalesce(1).mapInArrow(run, TREE_SCHEMA).collect())


def level_sums(prepared: DataFrame, layout: Layout, params: BoostingParams, number: int, done: list[Tree],
               tree: Tree, level: int, columns: np.ndarray) -> DataFrame:
    """Rows (cell, g, h): the sums of one level over all rows; a cell is node x cells + cell."""
    def add(batches):
        total = None
        for batch in batches:
            part = Part(batch, layout)
            for finished in done:
                part.replay(finished)
            part.begin(number, params)
            for above in range(level):
                part.descend(tree, above)
            own = part.sums(level, columns, layout)
            total = own if total is None else total + own
        if total is not None:
            flat = total.reshape(2, -1)
            at = np.flatnonzero(flat[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(flat[0, at]), pa.array(flat[1, at])], ["cell", "g", "h"])

    rows = prepared.mapInArrow(add, "cell bigint, g bigint, h bigint")
    return rows.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _by_jobs(prepared: DataFrame, layout: Layout, params: BoostingParams, first: int) -> list[Tree]:
    trees, open_ = [], []
    for number in range(first, first + params.rounds):
        def sums(tree, level, columns, number=number, done=tuple(open_)):
            out = np.zeros((2, 2 ** level * layout.cells), np.int64)
            for cell, g, h in level_sums(prepared, layout, params, number, done, tree, level, columns).collect():
                out[:, cell] = g, h
            return out.reshape(2, 2 ** level, layout.cells)

        tree = grow(sums, number, layout, params)
        trees.append(tree)
        open_.append(tree)
        if len(open_) == FOLD:
            prepared, open_ = settle(_replayed(prepared, layout, tuple(open_))), []
    return trees


def _replayed(prepared: DataFrame, layout: Layout, done: tuple[Tree, ...]) -> DataFrame:
    def add(batches):
        for batch in batches:
            part = Part(batch, layout)
            for tree in done:
                part.replay(tree)
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(part.margin))

    return prepared.mapInArrow(add, _PREPARED)


def boost(rows: DataFrame, features: int, params: BoostingParams = BoostingParams(), column: str = "features",
          label: str = "label", weight: str = "weight", margin: str | None = None, first: int = 0,
          edges: list | None = None, one_task_rows: int = ONE_TASK_ROWS) -> list[Tree]:
    """``params.rounds`` further trees, numbered from ``first``, on arrays of ``features`` doubles.

    Without ``margin`` the first tree starts from even odds; with it from the margin of the
    trees there are. Every round draws its share of rows and of columns; a leaf is minus the
    sum of gradients over that of hessians plus ``l2``, times the learning rate. NaN is
    missing: each split learns where it goes. ``edges`` are sorted cuts per feature; by
    default quantiles. Rows must have a label and a weight; without rows there are no trees.
    """
    layout = Layout([np.asarray(e, np.float64) for e in
                     (edges or quantile_edges(rows, features, column, params.bins))])
    prepared = _prepared(rows, layout, column, label, weight, margin)
    count = prepared.count()
    if not count:
        return []
    return (_in_one_task if count <= one_task_rows else _by_jobs)(prepared, layout, params, first)


def margins(features: Column, trees: list[Tree]) -> Column:
    """The sum of all trees for each row."""
    @F.pandas_udf("double")
    def total(values: pd.Series) -> pd.Series:
        out = np.zeros(len(values))
        if len(values):
            matrix = np.stack(values.to_numpy()).astype(np.float64)
            for tree in trees:
                out += tree.margin(matrix)
        return pd.Series(out)

    return total(features)


def staged_margins(features: Column, trees: list[Tree]) -> Column:
    """An array of the sums after each tree, in one pass."""
    @F.pandas_udf("array<double>")
    def staged(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        matrix = np.stack(values.to_numpy()).astype(np.float64)
        return pd.Series(list(np.cumsum([t.margin(matrix) for t in trees], axis=0).T))

    return staged(features)
