"""Bagged regression trees on sparse counts, fitted to all rows: tops are split by passes over the table, and what hangs below them is grown in tasks.

A node of more rows than a task should hold is split by sums that tasks make of their rows and a shuffle adds up: a pass for a level
of all trees. Once a node is small, a shuffle deals its rows to a task, which grows all below it level by level. Either way a level costs
the cells of the smaller children, which are summed, and the sums of the larger ones, whatever the number of nodes. The trees stay
a stored table, in pieces: neither the driver nor a task holds all of them.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch, ship_package, stage
from .boosting import GRADIENT, ROWS_AT_ONCE, Bins, _index_type, _packed, _unpacked, block_of, cells, quantile_edges, slices

#: Draws of a row into a bag beyond this many have a chance below 1e-12.
MOST_COPIES = 14
#: A task grows what hangs below a node of about so many cells at most, each counted as often as its row was drawn; larger nodes are split by passes.
NODE_CELLS = 1 << 21
#: A pass looks at so many rows at a time, or a batch more.
ROWS_HELD = 1 << 14
#: What a pass found is handed on by so many bytes.
BYTES_AT_ONCE = 1 << 23
#: A task that predicts holds trees of about so many nodes, and one whole tree at least.
NODES_HELD = 1 << 22
#: Predictions are summed over trees as whole multiples of 1/SHARE: integers add up to the same in any order.
SHARE = 1 << 20
_PARTS = {"feature": pa.int32(), "bin": pa.int16(), "below": pa.int32(), "value": pa.float64(), "gain": pa.float64()}
_PIECE = pa.schema([("tree", pa.int32()), ("node", pa.int32()), *((name, pa.list_(kind)) for name, kind in _PARTS.items())])
_PIECE_DDL = "tree int, node int, feature array<int>, bin array<smallint>, below array<int>, value array<double>, gain array<double>"
_SUMS_DDL = "tree int, parent int, node int, n bigint, g bigint, kinds binary, counts binary, totals binary"
_SPLIT = pa.schema([*((name, pa.int32()) for name in ("tree", "node")), *((name, pa.int64()) for name in ("n", "g")), ("kind", pa.int32()), ("gain", pa.float64()),
                    *((name, pa.int64()) for name in ("right_n", "right_g")), *((name, pa.binary()) for name in ("kinds", "counts", "totals"))])
_SPLIT_DDL = "tree int, node int, n bigint, g bigint, kind int, gain double, right_n bigint, right_g bigint, kinds binary, counts binary, totals binary"


@dataclass
class Forest(Bins):
    """Trees one after another in flat arrays: ``roots`` says where each begins, ``below`` the left child (the right one is next), feature -1 a leaf.

    Rows of a bin up to ``bin`` go left.
    """

    base: float
    roots: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    feature: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    bin: np.ndarray = field(default_factory=lambda: np.empty(0, np.int16))
    below: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.empty(0))
    gain: np.ndarray = field(default_factory=lambda: np.empty(0))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The value of each row (down) in each tree (across); a block descends all trees at once."""
        at, row = np.tile(self.roots, len(bins)), np.repeat(np.arange(len(bins)), len(self.roots))
        live = np.arange(len(at))
        while len(live):
            live = live[self.feature[at[live]] >= 0]
            node = at[live]
            at[live] = self.below[node] + (bins[row[live], self.feature[node]] > self.bin[node])
        return self.value[at].reshape(len(bins), -1)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """The mean over the trees."""
        return self.leaves(bins).mean(axis=1) if len(self.roots) else np.full(len(bins), self.base)


@dataclass
class StoredForest(Bins):
    """A fitted forest whose trees are rows of a stored table: their tops (node -1) and what hangs below nodes of these.

    A task that predicts takes one of ``groups`` groups of trees. ``pieces`` is None if there was no row to fit.
    """

    base: float
    groups: int
    pieces: DataFrame | None = None

    @cached_property
    def whole(self) -> Forest:
        """All trees on the driver, for a look at small ones; the fit and the predictions do without."""
        return Forest(self.edges, self.base, **_whole(self.pieces.toArrow())) if self.pieces is not None else Forest(self.edges, self.base)

    def __getattr__(self, name: str):
        if name in ("roots", *_PARTS):
            return getattr(self.whole, name)
        raise AttributeError(name)

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gain of the splits, the mean over the trees."""
        total = np.zeros(len(self.edges))
        if self.pieces is not None:
            splits = self.pieces.select("tree", F.inline(F.arrays_zip("feature", "gain"))).where("feature >= 0")
            by_tree = splits.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
            share = F.col("gain") / F.sum("gain").over(Window.partitionBy("tree"))
            for row in by_tree.select("feature", share.alias("share")).groupBy("feature").agg(F.sum("share").alias("share")).collect():
                total[row["feature"]] = row["share"]
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)


def _whole(pieces: pa.Table) -> dict[str, np.ndarray]:
    """Roots and flat arrays of the trees that come in ``pieces``, in any order; the first node of a piece stands where its top has a place for it."""
    tree, node = (pieces.column(name).to_numpy() for name in ("tree", "node"))
    columns = {name: pieces.column(name).combine_chunks() for name in _PARTS if name in pieces.column_names}
    lengths = np.diff(columns["value"].offsets.to_numpy()) if pieces.num_rows else np.zeros(0, np.int64)
    out = {name: np.zeros(int((lengths - (node >= 0)).sum()), np.int64 if name == "below" else _PARTS[name].to_pandas_dtype()) for name in columns}
    roots, size = {}, 0
    for i in np.lexsort((node, tree)):
        hangs = int(node[i] >= 0)
        shift = size - hangs
        place = np.arange(shift, shift + lengths[i])
        if hangs:
            place[0] = roots[tree[i]] + node[i]
        else:
            roots[tree[i]] = size
        for name, column in columns.items():
            values = column[int(i)].values.to_numpy(zero_copy_only=False)
            out[name][place] = np.where(values >= 0, values.astype(np.int64) + shift, -1) if name == "below" else values
        size += int(lengths[i]) - hangs
    # A tree whose bag drew no row has an open root and nothing that hangs there.
    return {"roots": np.array([root for root in roots.values() if not np.isnan(out["value"][root])], np.int64)} | out


def _numbered(values: np.ndarray, most: int) -> np.ndarray:
    """``values`` below ``most`` in the least type that holds them: two bytes sort by counting."""
    return values.astype(np.min_scalar_type(max(most - 1, 0)))


def _runs(node: np.ndarray, cell: np.ndarray, nodes: int, kinds: int, copies: np.ndarray, amount: np.ndarray) -> tuple[np.ndarray, ...]:
    """Node, kind of cell, copies and amount, summed and in order."""
    order = np.argsort(_numbered(cell, kinds), kind="stable")
    order = order[np.argsort(_numbered(node[order], nodes), kind="stable")]
    node, cell = node[order], cell[order]
    first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (cell[1:] != cell[:-1])]) if len(order) else order
    return node[first], cell[first], *(np.add.reduceat(x[order], first) if len(first) else x[:0] for x in (copies, amount))


def _spans(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.cumsum(length) + length, length) + np.arange(int(length.sum()))


def _best(at: np.ndarray, cell: np.ndarray, n: np.ndarray, g: np.ndarray, whole_n: np.ndarray, whole_g: np.ndarray, kind_index: np.ndarray) -> tuple[np.ndarray, ...]:
    """The run that parts each node best, if one gains, with its gain and the copies and the amount right of it.

    Runs lie node by node (``at``), in a node by kind (``cell``).
    """
    held = np.r_[True, at[1:] != at[:-1]]
    words = np.flatnonzero(held | np.r_[True, kind_index[cell[1:]] != kind_index[cell[:-1]]])
    held, lengths = np.flatnonzero(held), np.diff(np.r_[words, len(at)])
    # A run stands for the split below its bin: what has no cell, or a lower bin, goes left.
    before_n, before_g = (np.cumsum(x) - x for x in (n, g))
    right_n, right_g = (np.repeat(np.add.reduceat(x, words) + b[words], lengths) - b for x, b in ((n, before_n), (g, before_g)))
    left_n, left_g = whole_n[at] - right_n, whole_g[at] - right_g
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = (whole_g / whole_n)[at]
        # Over deviations from the node's mean, as squares of whole sums would cancel.
        gain = (left_g - left_n * mean) ** 2 / left_n + (right_g - right_n * mean) ** 2 / right_n
    gain = np.where((left_n > 0) & (right_n > 0), gain / GRADIENT ** 2, 0.0).round(6)
    best = np.maximum.reduceat(gain, held)
    is_best = np.flatnonzero(gain == np.repeat(best, np.diff(np.r_[held, len(at)])))
    chosen = is_best[np.r_[True, at[is_best[1:]] != at[is_best[:-1]]]]
    chosen = chosen[gain[chosen] > 0]
    return chosen, gain[chosen], right_n[chosen], right_g[chosen]


def grow_tree(price: np.ndarray, copies: np.ndarray, row: np.ndarray, index: np.ndarray, bins: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """A tree on rows that count ``copies`` times, and on their cells (row, index, bins >= 1; no cell: bin 0).

    Prices are summed as whole multiples of 1/GRADIENT, so no order of the rows changes the tree. Each cell is summed at the root, and
    then only where its row went to the child of fewer cells: what the other child holds is what its parent leaves.
    """
    amount = np.rint(price * GRADIENT).astype(np.int64) * copies
    index, bins = index.astype(np.int64), bins.astype(np.int64)
    # A kind of cell is a word with a bin; kinds are numbered by word, then bin.
    deepest = int(bins.max(initial=0)) + 1
    kinds, kind = np.unique(index * deepest + bins, return_inverse=True)
    kind_index, kind_bin = kinds // deepest, kinds % deepest
    by_row, by_kind = (np.argsort(_numbered(x, most), kind="stable") for x, most in ((row, len(price)), (kind, len(kinds))))
    of_row, sizes = kind[by_row], np.bincount(row, minlength=len(price))
    row_of_kind, word_ends = row[by_kind], np.searchsorted(index[by_kind], np.arange(int(index.max(initial=-1)) + 2))
    kind_of_kind, starts = kind[by_kind], np.cumsum(sizes) - sizes

    local, taking, first = np.zeros(len(price), np.int64), np.ones(len(price), bool), 0
    at, cell, n, g = _runs(np.zeros(len(row), np.int64), kind, 1, len(kinds), copies[row], amount[row])
    levels: list[tuple[np.ndarray, ...]] = []
    for level in range(depth + 1):
        nodes = int(local[taking].max()) + 1
        whole_n = np.bincount(local[taking], copies[taking], nodes).astype(np.int64)
        whole_g = np.zeros(nodes, np.int64)
        np.add.at(whole_g, local[taking], amount[taking])
        feature, cut, below, gained = np.full(nodes, -1), np.zeros(nodes, np.int64), np.full(nodes, -1), np.zeros(nodes)
        levels.append((feature, cut, below, whole_g / GRADIENT / whole_n, gained))
        if level == depth or not len(at):
            break
        chosen, gain = _best(at, cell, n, g, whole_n, whole_g, kind_index)[:2]
        if not len(chosen):
            break
        split = at[chosen]
        feature[split], cut[split], gained[split] = kind_index[cell[chosen]], kind_bin[cell[chosen]] - 1, gain
        below[split] = first + nodes + 2 * np.arange(len(split))
        # Rows go right by the cells of the words that split some node.
        used = np.unique(feature[split])
        cells = _spans(word_ends[used], word_ends[used + 1] - word_ends[used])
        cells = cells[taking[row_of_kind[cells]]]
        node, cell_of = local[row_of_kind[cells]], kind_of_kind[cells]
        right = np.zeros(len(price), np.int64)
        right[row_of_kind[cells[(feature[node] == kind_index[cell_of]) & (kind_bin[cell_of] > cut[node])]]] = 1
        taking = taking & (feature[np.where(taking, local, 0)] >= 0)
        first += nodes
        local[taking] = below[local[taking]] - first + right[taking]
        if level + 1 == depth:
            continue
        amounts = np.bincount(local[taking], sizes[taking], 2 * len(split))
        smaller = 2 * np.arange(len(split)) + (amounts[1::2] < amounts[::2])
        summed = np.flatnonzero(taking & (smaller[local // 2 * taking] == local))
        cells = _spans(starts[summed], sizes[summed])
        there = np.repeat(summed, sizes[summed])
        small = _runs(local[there], of_row[cells], 2 * len(split), len(kinds), copies[there], amount[there])
        # Of the runs of the nodes that were split, the larger child has what the smaller does not.
        child = np.full(nodes, -1)
        child[split] = smaller ^ 1
        at = child[at]
        kept = at >= 0
        at, cell, n, g = at[kept], cell[kept], n[kept], g[kept]
        order = np.argsort(at, kind="stable")
        at, cell, n, g = (x[order] for x in (at, cell, n, g))
        place = np.searchsorted(at * len(kinds) + cell, (small[0] ^ 1) * len(kinds) + small[1])
        n[place] -= small[2]
        g[place] -= small[3]
        left = n > 0
        at, cell, n, g = (np.concatenate([x[left], more]) for x, more in zip((at, cell, n, g), small))
    return dict(zip(("feature", "bin", "below", "value", "gain"), map(np.concatenate, zip(*levels))))


def _starts(edges: list[np.ndarray]) -> np.ndarray:
    """Where the kinds of cells of each feature begin: a kind is a feature with a bin from 1 on."""
    return np.cumsum([0, *(len(e) + 1 for e in edges)])


def _kinds(fitted: Bins, index: np.ndarray, values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    starts = _starts(fitted.edges)
    return (starts[index] + fitted.bins(index, values, row, rows)[row, index] - 1).astype(_index_type(int(starts[-1])))


def _binned(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kinds = _kinds(model.value, *block_of(batch, "indices", "values"), batch.num_rows)
            cells = _packed(kinds, batch.column("indices").offsets.to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("hashed"), batch.column("price"), cells], names=["hashed", "price", "cells"])
    return run


def draws(hashed: np.ndarray, tree: int) -> np.ndarray:
    """How often the bag of a tree draws each row: Poisson with mean 1 by a hash of the row's hash and the tree.

    So a bag is as large as the table on average, and the same at any partitioning.
    """
    x = hashed.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    drawn = (((x ^ (x >> np.uint64(31))) >> np.uint64(12)) + 0.5) / 2.0 ** 52
    return np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, MOST_COPIES)])), drawn)


@dataclass
class Top:
    """What passes have split of a tree, from the root (node 0) on: rows with a kind of cell from ``low`` up to below ``high`` go right, to the node after ``below``."""

    low: list[int] = field(default_factory=lambda: [-1])
    high: list[int] = field(default_factory=lambda: [-1])
    below: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    level: list[int] = field(default_factory=lambda: [0])
    n: list[int] = field(default_factory=lambda: [0])
    g: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, low: int, high: int, gain: float, right_n: int, right_g: int) -> int:
        """Tells the left child; the right one is next."""
        left = len(self.n)
        self.low[node], self.high[node], self.below[node], self.gain[node] = low, high, left, gain
        for n, g in ((self.n[node] - right_n, self.g[node] - right_g), (right_n, right_g)):
            for values, value in ((self.low, -1), (self.high, -1), (self.below, -1), (self.gain, 0.0), (self.level, self.level[node] + 1), (self.n, n), (self.g, g)):
                values.append(value)
        return left

    def open(self, depth: int, most: int) -> list[int]:
        """The nodes left to tasks. A root that no pass has looked at has n 0."""
        return [i for i, low in enumerate(self.low) if low < 0 and self.level[i] < depth and self.n[i] <= most and self.n[i] != 1]


class _Block:
    """Some rows with their cells by row and by kind."""

    def __init__(self, rows: pa.Table, kinds: int):
        rows = rows.combine_chunks()
        self.hashed, self.price, self.cells = rows.column("hashed").to_numpy(), rows.column("price").to_numpy(), rows.column("cells").chunk(0)
        self.kind, self.sizes = _unpacked(self.cells, _index_type(kinds))
        self.starts, order = np.cumsum(self.sizes) - self.sizes, np.argsort(self.kind, kind="stable")
        self.rows, self.ends = np.repeat(np.arange(len(self.sizes)), self.sizes)[order], np.searchsorted(self.kind[order], np.arange(kinds + 1))

    def members(self, tree: int, top: Top) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Copies of all rows, and the rows that were drawn by the node of ``top`` that they reach."""
        copies = draws(self.hashed, tree)
        held = {0: np.flatnonzero(copies)}
        # Children come after their parents.
        for node, low in enumerate(top.low):
            if low >= 0:
                right, rows = np.zeros(len(copies), bool), held.pop(node)
                right[self.rows[self.ends[low]:self.ends[top.high[node]]]] = True
                goes = right[rows]
                held[top.below[node]], held[top.below[node] + 1] = rows[~goes], rows[goes]
        return copies, held


def _blocks(batches: Iterator[pa.RecordBatch], kinds: int) -> Iterator[_Block]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= ROWS_HELD:
            yield _Block(pa.Table.from_batches(held), kinds)
            held = []
    if sum(x.num_rows for x in held):
        yield _Block(pa.Table.from_batches(held), kinds)


def _sums(state, kinds: int):
    """What the rows of a task that reach the nodes asked for add up to, by kind of cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, asked = state.value
        names = ["tree", "parent", "node", "n", "g", "kinds", "counts", "totals"]
        types = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.binary()] * 3
        for block in _blocks(batches, kinds):
            out, size = [], 0
            for tree, nodes in asked.items():
                copies, held = block.members(tree, tops[tree])
                for parent, node in nodes:
                    rows = held[node]
                    if len(rows):
                        times, sizes = copies[rows], block.sizes[rows]
                        amount = np.rint(block.price[rows] * GRADIENT).astype(np.int64) * times
                        kind = block.kind[_spans(block.starts[rows], sizes)].astype(np.intp)
                        counts, totals = (np.zeros(kinds, np.int64) for _ in range(2))
                        np.add.at(counts, kind, np.repeat(times, sizes))
                        np.add.at(totals, kind, np.repeat(amount, sizes))
                        found = np.flatnonzero(counts)
                        packed = [x.tobytes() for x in (found.astype(np.uint32), counts[found], totals[found])]
                        out.append((tree, parent, node, int(times.sum()), int(amount.sum()), *packed))
                        size += sum(map(len, packed))
                if size > BYTES_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), types)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), types)], names=names)
    return run


def _of_kinds(rows: pa.Table, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Copies and amounts by kind, over all rows."""
    out = tuple(np.zeros(kinds, np.int64) for _ in range(2))
    for row in zip(*(rows.column(name) for name in ("kinds", "counts", "totals"))):
        there = np.frombuffer(row[0].as_py(), np.uint32)
        for whole, part in zip(out, row[1:]):
            whole[there] += np.frombuffer(part.as_py(), np.int64)
    return out


def _split(starts: np.ndarray, most: int):
    """From the sums of a child, or of a root, and those kept of its parent: how it and its sibling are split best. Sums are kept of nodes beyond ``most``."""
    def run(key: tuple[pa.Scalar, ...], sums: pa.Table, kept: pa.Table) -> pa.Table:
        found, kinds = [], int(starts[-1])
        if sums.num_rows:
            node, n, g = sums.column("node")[0].as_py(), *(int(sums.column(name).to_numpy().sum()) for name in ("n", "g"))
            counts, totals = _of_kinds(sums, kinds)
            found.append((node, n, g, counts, totals))
            if kept.num_rows:
                whole_counts, whole_totals = _of_kinds(kept, kinds)
                # Children come in pairs, the left one of an odd number.
                found.append(((node - 1 ^ 1) + 1, kept.column("n")[0].as_py() - n, kept.column("g")[0].as_py() - g, whole_counts - counts, whole_totals - totals))
        kind_index, out = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), []
        for node, n, g, counts, totals in found:
            there = np.flatnonzero(counts)
            best, packed = (-1, 0.0, 0, 0), [b""] * 3
            if n > most and len(there):
                chosen = _best(np.zeros(len(there), np.int64), there, counts[there], totals[there], np.array([n]), np.array([g]), kind_index)
                if len(chosen[0]):
                    best = int(there[chosen[0][0]]), float(chosen[1][0]), int(chosen[2][0]), int(chosen[3][0])
                    packed = [x.tobytes() for x in (there.astype(np.uint32), counts[there], totals[there])]
            out.append((key[0].as_py(), node, n, g, *best, *packed))
        return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), _SPLIT.types)], schema=_SPLIT) if out else _SPLIT.empty_table()
    return run


def _tops(binned: DataFrame, starts: np.ndarray, trees: int, depth: int, most: int) -> dict[int, Top]:
    """Split all nodes of more than ``most`` rows, a pass a level. What reaches the driver are the splits of these nodes."""
    spark, kinds = binned.sparkSession, int(starts[-1])
    tops = {tree: Top() for tree in range(trees)}
    asked: dict[int, list[tuple[int, int]]] = {tree: [(-1, 0)] for tree in tops}
    kept = spark.createDataFrame([], "tree int, parent int, n bigint, g bigint, kinds binary, counts binary, totals binary")
    for level in range(depth):
        state = spark.sparkContext.broadcast((tops, asked))
        sums = binned.mapInArrow(_sums(state, kinds), _SUMS_DDL).groupBy("tree", "parent")
        found = stage(sums.cogroup(kept.groupBy("tree", "parent")).applyInArrow(_split(starts, most), _SPLIT_DDL), "forest-splits")
        asked = {}
        for row in found.where(F.col("n") > most).drop("kinds", "counts", "totals").collect():
            top, node = tops[row["tree"]], row["node"]
            top.n[node], top.g[node] = row["n"], row["g"]
            if row["kind"] >= 0:
                end = int(starts[np.searchsorted(starts, row["kind"], side="right")])
                left = top.split(node, row["kind"], end, row["gain"], row["right_n"], row["right_g"])
                if max(top.n[left:]) > most and level + 1 < depth:
                    asked.setdefault(row["tree"], []).append((node, left + (top.n[left + 1] < top.n[left])))
        state.unpersist()
        kept = found.where("length(kinds) > 0").select("tree", F.col("node").alias("parent"), "n", "g", "kinds", "counts", "totals")
        if not asked:
            break
    return tops


def _dealt(state, kinds: int, depth: int):
    """The drawn rows of the nodes left to tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, wanted = state.value
        for block in _blocks(batches, kinds):
            for tree, nodes in wanted.items():
                copies, held = block.members(tree, tops[tree])
                rows = np.concatenate([held[node] for node in nodes])
                if not len(rows):
                    continue
                node = np.repeat(nodes, [len(held[node]) for node in nodes]).astype(np.int32)
                left = depth - np.array(tops[tree].level, np.int32)[node]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), tree, np.int32)), pa.array(node), pa.array(left), pa.array(block.price[rows]),
                     pa.array(copies[rows].astype(np.int32)), block.cells.take(pa.array(rows))],
                    names=["tree", "node", "depth", "price", "copies", "cells"])
    return run


def _grown(starts: np.ndarray):
    def run(bag: pa.Table) -> pa.Table:
        kind, sizes = _unpacked(pa.concat_arrays(bag.column("cells").chunks), _index_type(int(starts[-1])))
        index = np.searchsorted(starts, kind, side="right") - 1
        row = np.repeat(np.arange(bag.num_rows), sizes)
        tree, node, depth = (bag.column(name)[0].as_py() for name in ("tree", "node", "depth"))
        grown = grow_tree(bag.column("price").to_numpy(), bag.column("copies").to_numpy().astype(np.int64), row, index, kind - starts[index] + 1, depth)
        return pa.Table.from_pydict({"tree": [tree], "node": [node]} | {name: [values] for name, values in grown.items()}, schema=_PIECE)
    return run


def _top_pieces(tops: dict[int, Top], starts: np.ndarray, wanted: dict[int, list[int]]) -> pa.Table:
    """The tops as pieces of trees; a node that hangs on has no value yet."""
    rows = []
    for tree, top in tops.items():
        low, n = np.array(top.low), np.maximum(top.n, 1)
        feature = np.where(low >= 0, np.searchsorted(starts, low, side="right") - 1, -1)
        value = np.array(top.g) / GRADIENT / n
        value[wanted.get(tree, [])] = np.nan
        rows.append({"tree": tree, "node": -1, "feature": feature, "bin": np.where(low >= 0, low - starts[feature], 0), "below": top.below, "value": value, "gain": top.gain})
    return pa.Table.from_pylist(rows, schema=_PIECE)


def fit_forest(rows: DataFrame, features: int, trees: int, depth: int, seed: int, most_bins: int) -> StoredForest:
    """Bagged trees on all ``rows`` (id, price, indices, values); every split looks at all features, down to single rows or ``depth``.

    The same trees at any partitioning, and wherever their tops end.
    """
    spark = rows.sparkSession
    ship_package(spark)
    with scratch(spark):
        # Dealt evenly, as few files would keep few tasks busy.
        rows = stage(rows.repartition(spark.sparkContext.defaultParallelism), "forest-cells")
        mean, count, cells_of_all = rows.agg(F.avg("price"), F.count("*"), F.sum(F.size("indices"))).first()
        # A bag has some 0.63 of the rows, and a tree at most two nodes a row.
        groups = min(trees, max(spark.sparkContext.defaultParallelism, 13 * count * trees // (10 * NODES_HELD)))
        model = StoredForest(quantile_edges(rows, features, most_bins), float(mean or 0.0), groups)
        if not count or not trees:
            return model
        starts = _starts(model.edges)
        kinds, most = int(starts[-1]), max(NODE_CELLS * count // max(cells_of_all, 1), 1)
        hashed = rows.select(F.xxhash64(F.lit(seed), "id").alias("hashed"), "price", "indices", "values")
        shared = spark.sparkContext.broadcast(Bins(model.edges))
        binned = stage(hashed.mapInArrow(_binned(shared), "hashed bigint, price double, cells binary"), "forest-rows")
        tops = _tops(binned, starts, trees, depth, most) if count > most and cells_of_all else {tree: Top() for tree in range(trees)}
        wanted = {tree: nodes for tree, top in tops.items() if (nodes := top.open(depth, most))}
        state = spark.sparkContext.broadcast((tops, wanted))
        dealt = binned.mapInArrow(_dealt(state, kinds, depth), "tree int, node int, depth int, price double, copies int, cells binary")
        # A partition of its own for every tree at least, as far as hashes allow: they are too few for adaptive merging to see their cost.
        dealt = dealt.repartition(max(trees, 2 * trees * count // most), "tree", "node")
        grown = dealt.groupBy("tree", "node").applyInArrow(_grown(starts), _PIECE_DDL)
        model.pieces = stage(grown.unionByName(spark.createDataFrame(_top_pieces(tops, starts, wanted), _PIECE_DDL)), "forest-trees", keep=True)
    return model


def _valued(edges: list[np.ndarray]):
    """The sum over the trees of a group for each vector, as the trees come first and the vectors pass by them."""
    starts = _starts(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pieces, forest = None, [], None
        for batch in batches:
            of, vector = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("group", "vector"))
            for this in np.unique(of):
                if this != group:
                    group, pieces, forest = this, [], None
                if (trees := np.flatnonzero((of == this) & ~vector)).size:
                    pieces.append(batch.take(pa.array(trees)).select(["tree", "node", "feature", "bin", "below", "value"]))
                there = np.flatnonzero((of == this) & vector)
                if there.size and forest is None:
                    forest, pieces = Forest(edges, 0.0, **_whole(pa.Table.from_batches(pieces))), []
                for first in range(0, len(there), ROWS_AT_ONCE):
                    rows = batch.take(pa.array(there[first:first + ROWS_AT_ONCE]))
                    kind, sizes = _unpacked(rows.column("cells"), _index_type(int(starts[-1])))
                    index, block = np.searchsorted(starts, kind, side="right") - 1, np.zeros((rows.num_rows, len(edges)), np.uint8)
                    block[np.repeat(np.arange(rows.num_rows), sizes), index] = kind - starts[index] + 1
                    total = np.rint(forest.leaves(block) * SHARE).astype(np.int64).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([rows.column("digest"), pa.array(total), pa.array(np.full(len(total), len(forest.roots), np.int64))], names=["digest", "total", "trees"])
    return run


def with_forest(df: DataFrame, model: StoredForest, vector: str = "bow", output: str = "_prediction") -> DataFrame:
    """Add the mean over the trees from a column of sparse counts.

    Each different vector, as the trees see it, passes by every group of trees once, known by a digest. A group lies in a task with the vectors streaming by.
    """
    if model.pieces is None:
        return df.withColumn(output, F.lit(model.base))
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Bins(model.edges))

    @F.pandas_udf("binary")
    def packed(indices: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for first in range(0, len(indices), ROWS_AT_ONCE):
            index, value = indices[first:first + ROWS_AT_ONCE], values[first:first + ROWS_AT_ONCE]
            ends = np.cumsum([0, *index.map(len)])
            flat = [np.concatenate([np.empty(0), *x]) for x in (index, value)]
            kinds = _kinds(shared.value, flat[0].astype(np.int64), flat[1], np.repeat(np.arange(len(index)), np.diff(ends)), len(index))
            out += [kinds[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        return pd.Series(out, dtype=object)

    keyed = df.withColumn("_cells", packed(cells(F.col(vector))["indices"], cells(F.col(vector))["values"]))
    keyed = keyed.withColumn("_digest", F.unhex(F.sha2("_cells", 256)))
    vectors = keyed.groupBy(F.col("_digest").alias("digest")).agg(F.first("_cells").alias("cells"))
    dealt = vectors.select(F.explode(F.sequence(F.lit(0), F.lit(model.groups - 1))).alias("group"), F.lit(True).alias("vector"), "digest", "cells")
    trees = model.pieces.drop("gain").select((F.col("tree") % model.groups).alias("group"), F.lit(False).alias("vector"), *model.pieces.drop("gain").columns)
    both = dealt.unionByName(trees, allowMissingColumns=True).repartitionById(model.groups, "group").sortWithinPartitions("group", "vector")
    valued = both.mapInArrow(_valued(model.edges), "digest binary, total bigint, trees bigint")
    mean = F.try_divide(F.sum("total"), F.sum("trees") * F.lit(float(SHARE)))
    means = valued.groupBy(F.col("digest").alias("_digest")).agg(mean.alias(output))
    return keyed.drop("_cells").join(means, "_digest", "left").withColumn(output, F.coalesce(output, F.lit(model.base))).drop("_digest")
