"""Boosted trees on binned features.

The features are binned once into one byte each, at exact quantiles.  Rows of the same bins, label and weight are kept once, with
their count: they have the same gradients and fall into the same samples.  Every level of a tree is one distributed
aggregate: a task adds the gradients and Hessians of its rows to a histogram over (node, feature, bin),
histograms are merged in groups on the executors, and the task that holds the merged one picks each node's best split; the driver reads
the splits, a few numbers a node.  The split gain is second order,
``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)``, and a leaf is worth ``-rate * G / (H + l)``.  Rows and columns are sampled per tree by hash.
Several estimators over the same features are fitted in step: one aggregate serves all of them.

Gradients are added as whole numbers (rounded to a step that suits the number of rows), so sums do not depend on the order or the
layout of the rows: the same rows give the same trees under any partitioning.

A partition holds about ``PARTITION_ROWS`` rows.  Up to ``ALONE`` times as many stay in one, where the work of a level is smaller than a job:
its histograms are already the merged ones, and one task for each estimator grows ``CHUNK`` trees with the same functions before it returns them.
Otherwise a level is an aggregate.

Blocks carry their rows' margins, which are brought up to date after each chunk of trees.  A tree's value is looked up: each feature's bin
leaves a set of leaves (one bit each), and the common one of all features is the row's leaf.  Between the aggregates of a chunk a Python worker keeps the
margins, gradients and nodes of its blocks.  They are a cache only: a worker that does not have them (a
lost executor, another placement) computes them from the block and the chunk's trees so far.

Ties between splits go to the first feature, then the lowest bin.  Rows with a null label are left out of the fit; with one class only
the model is a constant.  Features must not be null (the preparation fills them).
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator, MutableMapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.operators.scan import Scan, ordered_scan
from panelwatch.session import ensure_checkpoint_dir

#: rows of a block, rows that a partition of blocks holds about, and how many times as many one partition may hold where it is the only one
BLOCK_ROWS = 1 << 16
PARTITION_ROWS = 1 << 19
ALONE = 4
#: rows of which a worker keeps what it computed, histograms merged at once, trees between two updates of the margins (one partition, several)
CACHED_ROWS = 4_000_000
MERGE = 16
CHUNK = 25
CHUNK_SPREAD = 10
#: combinations of bins that one lookup table holds, and that are counted together in one histogram
TABLE = 1 << 12
JOINT = 1 << 9
LEAF = -1


# ---------------------------------------------------------------- binning
def bin_edges(df: DataFrame, features_col: str, max_bins: int) -> list[list[float]]:
    """For each feature the upper ends of its bins: every distinct value where there are
    at most ``max_bins``, else exact quantiles (one distributed scan for all features)."""
    long = df.select(F.posexplode(vector_to_array(features_col)).alias("feature", "value"))
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    one = F.lit(1).cast("long")
    ranked = ordered_scan(counts, ["feature"], ["value"], [Scan("below", "sum", "n", inclusive=False), Scan("rank", "sum", one, inclusive=False)],
                          totals={"total": "n", "kinds": one})
    place = F.when(F.col("kinds") <= max_bins, F.col("rank")).otherwise(F.floor(F.col("below") * max_bins / F.col("total")))
    rows = ranked.groupBy("feature", place.alias("bin")).agg(F.max("value").alias("edge")).collect()  # at most max_bins a feature
    out: list[list[float]] = [[] for _ in range(max((r["feature"] for r in rows), default=-1) + 1)]
    for r in sorted(rows, key=lambda r: r["bin"]):
        out[r["feature"]].append(r["edge"])
    return out


def binned(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin numbers (feature x row): the first bin whose upper end is not below the value; larger values join the last bin."""
    out = np.zeros((len(edges), len(x)), np.uint8)
    for f, e in enumerate(edges):
        out[f] = np.searchsorted(np.asarray(e[:-1]), x[:, f], side="left")
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _packed(df: DataFrame, features_col: str, label_col: str, weight_col: str | None, edges) -> DataFrame:
    """The distinct binned rows (one byte for each feature, label, weight) and how often each occurs."""
    rows = df.where(F.col(label_col).isNotNull()).select(
        vector_to_array(features_col).alias("x"), F.col(label_col).cast("double").alias("y"),
        (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("w"))
    width = len(edges)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            bins = binned(np.asarray(batch.column(0).flatten()).reshape(n, -1), edges)
            at = np.arange(n + 1, dtype=np.int32) * np.int32(width)
            each = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(bins.T))])
            y = np.asarray(batch.column(1)).astype(np.uint8).astype(np.int16)
            yield pa.RecordBatch.from_arrays([each, pa.array(y), batch.column(2)], names=["bins", "y", "w"])

    return rows.mapInArrow(run, "bins binary, y short, w double").groupBy("bins", "y", "w").agg(F.count(F.lit(1)).alias("n"))


def _blocks(cells: DataFrame, n_features: int, base: float, models: int):
    """Distinct rows in blocks.  Rows of the same bins lie together and are one cell: a block is its number of rows, its name, the cells' bins (feature x
    cell) and first rows, the rows' labels, weights, counts and hashes of their content, and the cells' margins for each estimator."""
    def block(parts):
        n = sum(p.num_rows for p in parts)
        bins = np.concatenate([np.frombuffer(b"".join(p.column(0).to_pylist()), np.uint8).reshape(p.num_rows, n_features) for p in parts])
        y, w, c = (np.concatenate([np.asarray(p.column(k)) for p in parts]) for k in (1, 2, 3))
        key = _mixed(y.astype(np.uint64) + np.uint64(1))
        for b in bins.T:
            key = _mixed(key * np.uint64(31) + b)
        first = np.flatnonzero(np.concatenate([[True], (bins[1:] != bins[:-1]).any(axis=1)]))
        columns = [np.ascontiguousarray(bins[first].T).tobytes(), first.astype(np.int64).tobytes(), y.astype(np.uint8).tobytes(),
                   w.astype(np.float64).tobytes(), c.astype(np.int64).tobytes(), key.tobytes()]
        name = hashlib.blake2b(b"".join(columns), digest_size=12).digest()
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *[pa.array([x], pa.binary()) for x in (name, *columns)]],
                                          names=["n", "name", "bins", "first", "y", "w", "c", "key"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                if n + part.num_rows > BLOCK_ROWS and held:
                    yield block(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield block(held)

    rows = cells.mapInArrow(run, "n long, name binary, bins binary, first binary, y binary, w binary, c binary, key binary").rdd
    return rows.map(lambda r: (r[0], *[bytes(x) for x in r[1:]], [np.full(len(r[3]) // 8, base).tobytes()] * models))


# ---------------------------------------------------------------- trees
@dataclass
class Tree:
    """A binary tree as heap arrays (root 1, children 2k and 2k+1); a node without a feature is a leaf."""

    feature: np.ndarray
    cut: np.ndarray  # rows whose bin exceeds it go right
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(np.full(n, LEAF, np.int16), np.zeros(n, np.uint8), np.zeros(n), np.zeros(n))

    def places(self, bins: np.ndarray, steps: int) -> np.ndarray:
        """The node that each row reaches after at most ``steps`` splits."""
        node = np.ones(bins.shape[1], np.int64)
        rows = np.arange(bins.shape[1])
        for _ in range(steps):
            f = self.feature[node]
            inner = f != LEAF
            if not inner.any():
                break
            right = bins[np.where(inner, f, 0), rows] > self.cut[node]
            node = np.where(inner, 2 * node + right, node)
        return node

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "found"}

    def lookup(self, shape: Shape) -> Lookup:
        """The tree as lookup tables, made once."""
        if "found" not in self.__dict__:
            self.found = Lookup.of(self, shape)
        return self.found

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 2

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.places(bins, self.depth)]


@dataclass(frozen=True)
class Shape:
    """Numbers of bins of the features, and groups of features whose bins make at most ``TABLE`` combinations."""

    kinds: tuple[int, ...]
    groups: list[list[int]]

    @classmethod
    def of(cls, edges: Sequence[Sequence[float]]) -> Shape:
        kinds = tuple(max(1, len(e)) for e in edges)
        return cls(kinds, _together(kinds, range(len(kinds)), TABLE))

    def code(self, bins: np.ndarray, group: Sequence[int]) -> np.ndarray:
        """Numbers of the combinations of bins of some features."""
        code = bins[group[0]].astype(np.uint16)  # at most TABLE
        for f in group[1:]:
            code = code * np.uint16(self.kinds[f]) + bins[f]
        return code

    def codes(self, bins: np.ndarray) -> list[np.ndarray]:
        return [self.code(bins, g) for g in self.groups]


def _together(kinds: Sequence[int], features: Sequence[int], most: int) -> list[list[int]]:
    """Groups of neighbouring features whose bins make at most ``most`` combinations (or a single feature)."""
    groups, size = [], most + 1
    for f in features:
        if size * kinds[f] > most:
            groups.append([])
            size = 1
        groups[-1].append(int(f))
        size *= kinds[f]
    return groups


@dataclass(frozen=True)
class Lookup:
    """A tree of at most 64 leaves as tables: for each group of features and combination of bins the leaves that it leaves open, as bits.  The bit that all
    groups have in common is the row's leaf."""

    tables: list[tuple[int, np.ndarray]]
    value: np.ndarray

    @classmethod
    def of(cls, tree: Tree, shape: Shape) -> Lookup | None:
        """None for a tree with more leaves."""
        leaves: list[int] = []
        splits: dict[int, list[tuple[int, int, int]]] = {}
        feature, cut = tree.feature.tolist(), tree.cut.tolist()

        def bits(node: int) -> int:
            if feature[node] == LEAF:
                leaves.append(node)
                return 1 << (len(leaves) - 1)
            left, right = bits(2 * node), bits(2 * node + 1)
            splits.setdefault(feature[node], []).append((cut[node], left, right))
            return left | right

        every = bits(1)
        if len(leaves) > 64:
            return None
        masks = {}
        for f, found in splits.items():
            at, left, right = (np.array(x, np.uint64) for x in zip(*found))
            over = np.arange(shape.kinds[f], dtype=np.uint64)[:, None] > at
            masks[f] = np.bitwise_and.reduce(np.where(over, ~left, ~right), axis=1)
        tables = []
        for g, group in enumerate(shape.groups):
            if any(f in masks for f in group):
                table = np.array([every], np.uint64)
                for f in group:
                    m = masks[f] if f in masks else np.full(shape.kinds[f], every, np.uint64)
                    table = (table[:, None] & m[None, :]).ravel()
                tables.append((g, table))
        return cls(tables, tree.value[leaves])

    def margins(self, codes: Sequence[np.ndarray]) -> np.ndarray | float:
        if not self.tables:
            return self.value[0]
        left = None
        for g, table in self.tables:
            found = table.take(codes[g])
            left = found if left is None else np.bitwise_and(left, found, out=left)
        # the exponent of a power of two
        return self.value.take((left.astype(np.float64).view(np.int64) >> 52) - 1023)


def _advanced(margins: np.ndarray, trees: Sequence[Tree], shape: Shape, codes: Sequence[np.ndarray], bins: np.ndarray) -> np.ndarray:
    """Margins after some more trees."""
    for tree in trees:
        lookup = tree.lookup(shape)
        margins = margins + (tree.margins(bins) if lookup is None else lookup.margins(codes))
    return margins


@dataclass
class Growing:
    """One estimator's state: the chunk's finished trees, the number of those before them, and the tree in hand."""

    params: dict
    before: int
    recent: list[Tree]
    tree: Tree
    level: int
    columns: np.ndarray

    @property
    def number(self) -> int:
        return self.before + len(self.recent)


class Block:
    """Views of a block's rows and cells (see :func:`_blocks`)."""

    def __init__(self, fit: Fit, block):
        self.name, self.margins = block[1], block[8]
        self.bins = np.frombuffer(block[2], np.uint8).reshape(len(fit.shape.kinds), -1)
        self.first, self.y, self.w, self.c, self.key = (np.frombuffer(b, t) for b, t in zip(block[3:8], (np.int64, np.uint8, np.float64, np.int64, np.uint64)))

    def work(self, fit: Fit, model: int, done: int) -> Work:
        """A fresh start from the margins that the block carries."""
        return Work(np.frombuffer(self.margins[model]), done, fit.shape.codes(self.bins))


class Work:
    """What an estimator needs of a block: the margins of its cells after the finished trees, and of the cells with sampled rows that are still in open
    nodes of the tree in hand their bins, nodes (within the level), gradients and Hessians (in whole steps, summed over the rows)."""

    def __init__(self, margins: np.ndarray, done: int, codes: list[np.ndarray]):
        self.margins, self.done, self.codes = margins, done, codes
        self.number, self.level = -1, 0

    def to(self, g: Growing, fit: Fit, block: Block) -> None:
        """Bring the cells to the open level of the tree in hand."""
        self.margins = _advanced(self.margins, g.recent[self.done - g.before:], fit.shape, self.codes, block.bins)
        self.done = g.number
        if self.number != g.number or self.level > g.level:
            self._begin(g, fit, block)
        while self.level < g.level:
            first = 1 << self.level
            feature, cut = g.tree.feature[first:2 * first].astype(np.intp), g.tree.cut[first:2 * first]
            inner = feature != LEAF
            if not inner.all():
                keep = np.flatnonzero(inner.take(self.node))
                self.bins, self.joint = self.bins.take(keep, axis=1), [code.take(keep) for code in self.joint]
                self.node, self.grad, self.hess = self.node.take(keep), self.grad.take(keep), self.hess.take(keep)
            n = len(self.node)
            at = (feature * n).take(self.node)
            at += np.arange(n)
            self.node = 2 * self.node + (self.bins.reshape(-1).take(at) > cut.take(self.node))
            self.level += 1

    def _begin(self, g: Growing, fit: Fit, block: Block) -> None:
        p, n = 1 / (1 + np.exp(-self.margins)), len(block.y)
        if len(p) < n:
            p = np.repeat(p, np.diff(block.first, append=n))
        times = block.c * _sampled(block.key, g.number, g.params)
        grad = np.rint(block.w * (p - block.y) / fit.step).astype(np.int64) * times
        hess = np.rint(block.w * p * (1 - p) / fit.step).astype(np.int64) * times
        if len(self.margins) < n:
            last = np.append(block.first[1:], n) - 1
            grad, hess = (np.diff(np.cumsum(x).take(last), prepend=0) for x in (grad, hess))
        pick = np.flatnonzero(grad | hess)
        self.bins, self.node = block.bins.take(pick, axis=1), np.zeros(len(pick), np.intp)
        self.grad, self.hess = grad.take(pick), hess.take(pick)
        self.groups = _together(fit.shape.kinds, g.columns, JOINT)
        self.joint = [fit.shape.code(self.bins, group) for group in self.groups]
        self.number, self.level = g.number, 0

    def histogram(self, shape: Shape, n_bins: int) -> np.ndarray:
        """Gradients and Hessians by open node, sampled column and bin: exact sums of whole numbers.  Features with few bins are counted together."""
        nodes, out = 1 << self.level, []
        for group, code in zip(self.groups, self.joint):
            kinds = [shape.kinds[f] for f in group]
            sums = np.zeros((2, nodes * math.prod(kinds)), np.int64)
            cell = self.node * math.prod(kinds) + code
            np.add.at(sums[0], cell, self.grad)
            np.add.at(sums[1], cell, self.hess)
            sums = sums.reshape(2, nodes, *kinds)
            for k, kind in enumerate(kinds):
                one = np.zeros((2, nodes, n_bins), np.int64)
                one[:, :, :kind] = sums.sum(axis=tuple(2 + j for j in range(len(kinds)) if j != k))
                out.append(one)
        return np.stack(out, axis=2)


class Kept(OrderedDict):
    """Work of at most about ``CACHED_ROWS`` rows, the least recent ones leave first."""

    def __setitem__(self, key, work: Work) -> None:
        super().__setitem__(key, work)
        self.move_to_end(key)
        while sum(len(x.margins) for x in self.values()) > CACHED_ROWS and len(self) > 1:
            self.popitem(last=False)


_kept = Kept()


def _sampled(key: np.ndarray, number: int, params: dict) -> np.ndarray:
    if params["subsample"] >= 1:
        return np.ones(len(key), bool)
    h = _mixed(key ^ np.uint64((params["seed"] * 1_000_003 + number * 7919 + 1) % (1 << 64)))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < params["subsample"]


def _merged(parts) -> list[np.ndarray] | None:
    total = None
    for one in parts:
        total = one if total is None else [a + b for a, b in zip(total, one)]
    return total


@dataclass(frozen=True)
class Fit:
    """What every aggregate of one fit shares."""

    name: str
    settings: list[dict]
    step: float
    n_bins: int
    shape: Shape

    def histograms(self, blocks, growing: list[Growing], kept: MutableMapping) -> list[np.ndarray] | None:
        """The histograms of all estimators' open levels, summed over some blocks; ``kept`` holds what was computed before."""
        def each():
            for row in blocks:
                block, found = Block(self, row), []
                for g in growing:
                    at = (self.name, g.params["model"], block.name)
                    work = kept.get(at)
                    if work is None or not g.before <= work.done <= g.number:
                        work = block.work(self, g.params["model"], g.before)
                    work.to(g, self, block)
                    kept[at] = work
                    found.append(work.histogram(self.shape, self.n_bins))
                yield found

        return _merged(each())

    def splits(self, histograms: list[np.ndarray], growing: list[Growing]) -> list[list[tuple]]:
        """The best splits of all estimators' open nodes, from their merged histograms: a few numbers a node."""
        return [list(best_splits(h, self.step, g.params["l2"], g.params["min_child"])) for g, h in zip(growing, histograms)]

    def grow(self, numbers: range, models: Sequence[int], best) -> list[list[Tree]]:
        """The trees with these numbers of some estimators; ``best`` gives the best splits of open levels over all rows."""
        recent: list[list[Tree]] = [[] for _ in self.settings]
        for number in numbers:
            growing = [Growing(s, numbers[0], recent[m], Tree.empty(s["depth"]), 0, _columns(s, number, len(self.shape.kinds)))
                       for m in models if number < (s := self.settings[m])["trees"]]
            while open_ := [g for g in growing if g.level < g.params["depth"] and _is_open(g)]:
                for g, found in zip(open_, best(open_)):
                    _split(g, found)
            for g in growing:
                recent[g.params["model"]].append(g.tree)
        return recent

    def advanced(self, block, new: list[list[Tree]]):
        """A block with the margins after some more trees of each estimator."""
        x = Block(self, block)
        codes = self.shape.codes(x.bins)
        return *block[:8], [_advanced(np.frombuffer(m), trees, self.shape, codes, x.bins).tobytes() for m, trees in zip(x.margins, new)]


def _over_all(blocks, fit: Fit, growing: list[Growing]) -> list[list[tuple]]:
    """One distributed aggregate: the histograms over all blocks, merged on executors in rounds of ``MERGE``; the last
    round's task picks the splits, so the driver reads no histogram."""
    def run(rows):
        from panelwatch.operators import boosting  # the worker's own

        total = fit.histograms(rows, growing, boosting._kept)
        return [] if total is None else [total]

    parts, n = blocks.mapPartitions(run), blocks.getNumPartitions()
    while n > 1:
        n = math.ceil(n / MERGE)
        parts = (parts.mapPartitionsWithIndex(lambda i, it, n=n: ((i % n, h) for h in it))
                 .reduceByKey(lambda a, b: [p + q for p, q in zip(a, b)], n).values())
    return parts.map(lambda merged: fit.splits(merged, growing)).collect()[0]


def _in_one_task(blocks, fit: Fit, numbers: range) -> list[list[Tree]]:
    """The same trees where one partition holds all rows: its histograms are the merged ones, so a task for each estimator goes on by itself."""
    def run(model, rows):
        held, kept = list(rows), {}
        return fit.grow(numbers, [model], lambda growing: fit.splits(fit.histograms(held, growing, kept), growing))[model:model + 1]

    return blocks.context.union([blocks] * len(fit.settings)).mapPartitionsWithIndex(run).collect()


def best_splits(hist: np.ndarray, step: float, l2: float, min_child: float):
    """Of each node (gain, column, bin, left G, left H, G, H); gain 0 where no split helps."""
    grad, hess = hist[0] * step, hist[1] * step
    G, H = grad[:, 0].sum(axis=1), hess[:, 0].sum(axis=1)
    gl, hl = np.cumsum(grad, axis=2)[:, :, :-1], np.cumsum(hess, axis=2)[:, :, :-1]
    gr, hr = G[:, None, None] - gl, H[:, None, None] - hl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - (G * G / (H + l2))[:, None, None]
    gain = np.where((hl >= min_child) & (hr >= min_child), gain, 0)
    flat = gain.reshape(len(gain), -1)
    # equal up to rounding: the first column and bin
    at = (flat >= flat.max(axis=1, keepdims=True) * (1 - 1e-12)).argmax(axis=1) if flat.shape[1] else np.zeros(len(gain), int)
    for k, a in enumerate(at):
        if flat.shape[1] and flat[k, a] > 1e-12:
            c, b = divmod(int(a), gain.shape[2])
            yield float(flat[k, a]), c, b, float(gl[k, c, b]), float(hl[k, c, b]), float(G[k]), float(H[k])
        else:
            yield 0.0, 0, 0, 0.0, 0.0, float(G[k]), float(H[k])


def _columns(params: dict, number: int, n_features: int) -> np.ndarray:
    """The columns of a tree: the share with the smallest hashes."""
    h = _mixed(np.arange(n_features, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(params["seed"] * 31 + number + 1))
    return np.sort(np.argsort(h, kind="stable")[:max(1, round(params["col_sample"] * n_features))])


def fit_together(df: DataFrame, estimators: Sequence["BoostedTrees"]) -> list["BoostedTreesModel"]:
    """Fit several estimators over the same feature, label and weight columns, one aggregate for a level of all of them."""
    first = estimators[0]
    fcol, lcol = first.getFeaturesCol(), first.getLabelCol()
    wcol = first.getWeightCol() if first.isDefined(first.weightCol) else None
    n_bins = max(e.getOrDefault(e.maxBins) for e in estimators)
    edges = bin_edges(df, fcol, n_bins)
    packed = _packed(df, fcol, lcol, wcol, edges)
    weight = F.col(wcol).cast("double") if wcol else F.lit(1.0)
    known = df.where(F.col(lcol).isNotNull())
    top = known.agg(F.count(F.lit(1)).alias("n"), F.max(weight).alias("w")).first()
    n, most = top["n"], top["w"] or 1.0
    step = most / 2.0 ** min(36, 61 - max(n, 1).bit_length())  # sums of all rows fit into a long
    sums = known.agg(*[F.sum(F.when(F.col(lcol) == c, F.round(weight / step).cast("long")).otherwise(0)).alias(f"c{c}") for c in (0, 1)]).first()
    neg, pos = sums["c0"] or 0, sums["c1"] or 0
    base = math.log(pos / neg) if pos and neg else (30.0 if pos else -30.0 if neg else 0.0)
    trees: list[list[Tree]] = [[] for _ in estimators]
    if pos and neg and edges:
        ensure_checkpoint_dir(df.sparkSession)
        packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
        distinct = packed.count()
        parts = math.ceil(distinct / PARTITION_ROWS) if distinct > ALONE * PARTITION_ROWS else 1
        blocks = _blocks(packed.repartition(parts, "bins").sortWithinPartitions(F.xxhash64("bins"), "bins"), len(edges), base, len(estimators)).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.checkpoint()  # every aggregate starts from these files or the cached blocks, not from the panel
        blocks.count()
        packed.unpersist()
        trees = _grow(blocks, estimators, step, n_bins, Shape.of(edges))
    return [e._model(edges, base, own) for e, own in zip(estimators, trees)]


def _grow(blocks, estimators, step, n_bins, shape) -> list[list[Tree]]:
    """All trees, chunk after chunk; the blocks' margins follow."""
    settings = [{"model": m, "subsample": e.getOrDefault(e.subsamplingRate), "col_sample": e.getOrDefault(e.colSample), "seed": e.getOrDefault(e.seed),
                 "l2": e.getOrDefault(e.l2), "min_child": e.getOrDefault(e.minChildWeight), "depth": e.getOrDefault(e.maxDepth),
                 "rate": e.getOrDefault(e.stepSize), "trees": e.getOrDefault(e.maxIter)} for m, e in enumerate(estimators)]
    fit = Fit(uuid.uuid4().hex, settings, step, n_bins, shape)
    done: list[list[Tree]] = [[] for _ in settings]
    most, alone, older = max(s["trees"] for s in settings), blocks.getNumPartitions() == 1, None
    chunk = CHUNK if alone else CHUNK_SPREAD
    try:
        for a in range(0, most, chunk):
            numbers = range(a, min(a + chunk, most))
            new = _in_one_task(blocks, fit, numbers) if alone else fit.grow(numbers, range(len(settings)), lambda growing: _over_all(blocks, fit, growing))
            for trees, made in zip(done, new):
                trees += made
            if older is not None:
                older.unpersist()  # the first aggregate of the chunk has read it
            older, blocks = blocks, blocks.map(lambda block, new=new: fit.advanced(block, new)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for kept in (older, blocks):
            kept.unpersist() if kept is not None else None
    return done


def _is_open(g: Growing) -> bool:
    """Whether some node of the level has rows: the root, or a child of a split."""
    if g.level == 0:
        return True
    parents = np.arange(1 << (g.level - 1), 1 << g.level)
    return bool((g.tree.feature[parents] != LEAF).any())


def _split(g: Growing, found: list[tuple]) -> None:
    """Split the level's nodes where that helps and give the children their values."""
    l2, rate, first = g.params["l2"], g.params["rate"], 1 << g.level
    for k, (gain, c, b, gl, hl, G, H) in enumerate(found):
        node = first + k
        if g.level == 0:
            g.tree.value[node] = -rate * G / (H + l2) if H + l2 > 0 else 0.0
        if gain > 0:
            g.tree.feature[node], g.tree.cut[node], g.tree.gain[node] = g.columns[c], b, gain
            g.tree.value[2 * node], g.tree.value[2 * node + 1] = -rate * gl / (hl + l2), -rate * (G - gl) / (H - hl + l2)
    g.level += 1


# ---------------------------------------------------------------- pipeline stages
class _Shape(HasFeaturesCol, HasLabelCol, HasWeightCol, Params):
    """Columns that both the estimator and the model carry."""


class BoostedTrees(Estimator, _Shape, DefaultParamsReadable, DefaultParamsWritable):
    """M11/M12 as a pipeline stage."""

    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a leaf's value that is added", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows per tree", TypeConverters.toFloat)
    colSample = Param(Params._dummy(), "colSample", "share of columns per tree", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature (at most 256)", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty on leaf values", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least Hessian sum of a child", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the row and column hashes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, maxIter=400, maxDepth=5, stepSize=0.05,
                 subsamplingRate=0.85, colSample=0.85, maxBins=64, l2=1.0, minChildWeight=1.0, seed=42):
        super().__init__()
        self._setDefault(maxIter=400, maxDepth=5, stepSize=0.05, subsamplingRate=0.85, colSample=0.85, maxBins=64, l2=1.0,
                         minChildWeight=1.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "BoostedTreesModel":
        return fit_together(df, [self])[0]

    def _model(self, edges, base: float, trees: list[Tree]) -> "BoostedTreesModel":
        ensemble = {"edges": edges, "base": base, "feature": [t.feature.tolist() for t in trees], "cut": [t.cut.tolist() for t in trees],
                    "value": [t.value.tolist() for t in trees], "gain": [t.gain.tolist() for t in trees]}
        own = {k: self.getOrDefault(k) for k in ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "colSample", "maxBins", "l2", "minChildWeight", "seed")}
        return BoostedTreesModel(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), ensemble=json.dumps(ensemble), settings=json.dumps(own))


class BoostedTreesModel(Model, _Shape, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; ``transform`` adds ``rawPrediction``, ``probability`` and ``prediction``."""

    ensemble = Param(Params._dummy(), "ensemble", "bin edges and trees as JSON", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "the estimator's parameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", ensemble=None, settings=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def description(self) -> dict:
        """The estimator's parameters, for the run log."""
        return json.loads(self.getOrDefault(self.settings))

    def trees(self) -> tuple[list[list[float]], float, list[Tree]]:
        d = json.loads(self.getOrDefault(self.ensemble))
        trees = [Tree(np.array(f, np.int16), np.array(c, np.uint8), np.array(v), np.array(g))
                 for f, c, v, g in zip(d["feature"], d["cut"], d["value"], d["gain"])]
        return d["edges"], d["base"], trees

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the total gain by feature."""
        edges, _, trees = self.trees()
        total = np.zeros(len(edges))
        for t in trees:
            np.add.at(total, t.feature[t.feature != LEAF], t.gain[t.feature != LEAF])
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.trees())

        @F.arrow_udf("double")
        def margin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            edges, base, trees = shared.value
            shape = Shape.of(edges)
            for x in batches:
                if not len(x):
                    yield pa.array([], pa.float64())
                    continue
                bins = binned(np.asarray(x.flatten()).reshape(len(x), -1), edges)
                yield pa.array(_advanced(np.full(len(x), base), trees, shape, shape.codes(bins), bins))

        m = margin(vector_to_array(self.getFeaturesCol()))
        p = F.lit(1.0) / (1 + F.exp(-F.col("__margin")))
        out = df.withColumn("__margin", m)
        return out.withColumns({"rawPrediction": array_to_vector(F.array(-F.col("__margin"), F.col("__margin"))),
                                "probability": array_to_vector(F.array(1 - p, p)),
                                "prediction": (F.col("__margin") > 0).cast("double")}).drop("__margin")
