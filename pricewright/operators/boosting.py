"""Gradient boosted trees on sparse counts, grown level by level from histograms that Spark sums.

A level of a tree is one pass: tasks sum the gradient and the hessian of their
rows per (node, feature, bin), a shuffle of ranges of cells adds these up, and
the driver picks the splits. What reaches it is bounded by nodes times bins, whatever the rows. Of
two children only the smaller is summed: the other is what its parent leaves.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch, ship_package, stage

#: Gradients are summed as whole multiples of 1/GRADIENT, squared errors of residuals rounded to 1/ERROR: integers add up to the same in any order.
GRADIENT, ERROR = 10_000, 16
ROWS_AT_ONCE = 1024
#: Rows lie in so many partitions per core, whatever their number: a pass shuffles what its tasks found, partition by partition.
PARTITIONS_PER_CORE = 2
#: Cells are counted once so many are together.
CELLS_AT_ONCE = 1 << 20
#: What all tasks found is added up in groups of so many cells, as far as there are cores for them.
CELLS_SUMMED = 1 << 20
_SUMS = "part int, keys binary, totals binary, counts binary"
#: After so many trees the rows are stored again with what those predict.
TREES_AT_ONCE = 16
TRAIN_ERROR, HELD_ERROR, HELD_ROWS = -1, -2, -3


@dataclass
class Tree:
    """Nodes of a binary tree by number (children of i: 2i+1 and 2i+2); feature -1 marks a leaf. Rows of a bin up to ``bin`` go left."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def of_depth(depth: int) -> "Tree":
        size = (2 << depth) - 1
        return Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size))

    def leaf_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            feature = self.feature[node]
            down = 2 * node + 1 + (bins[row, feature] > self.bin[node])
            node = np.where(feature >= 0, down, node)
        return node


@dataclass
class Bins:
    """The edges of the bins of each feature's counts."""

    edges: list[np.ndarray]

    def bins(self, index: np.ndarray, values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """A dense block of bin numbers: 0 for no count, else one more than the edges below the value."""
        block = np.zeros((rows, len(self.edges)), np.uint8)
        width = max(map(len, self.edges), default=0)
        table = np.full((len(self.edges), max(width, 1)), np.inf)
        for i, found in enumerate(self.edges):
            table[i, :len(found)] = found
        block[row, index] = 1 + (table[index] < values[:, None]).sum(axis=1)
        return block


@dataclass
class BoostedTrees(Bins):
    """A fitted ensemble; ``errors`` holds the root mean squared error on train and held-out rows before each round and after the last."""

    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    errors: list[tuple[float, float | None]] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(len(self.edges))
        for tree in self.trees:
            split = tree.feature >= 0
            np.add.at(total, tree.feature[split], tree.gain[split])
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def margin(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        """What the trees from number ``first`` on add up to, in their order; a block descends all of them at once."""
        trees = self.trees[first:]
        if not trees:
            return np.zeros(len(bins))
        feature, cut, value = (np.stack([getattr(tree, name) for tree in trees]).ravel() for name in ("feature", "bin", "value"))
        size = len(trees[0].feature)
        root = np.repeat(np.arange(len(trees)) * size, len(bins))
        node, row = root.copy(), np.tile(np.arange(len(bins)), len(trees))
        for _ in range(self.depth):
            at = feature[node]
            down = 2 * node - root + 1 + (bins[row, at] > cut[node])
            node = np.where(at >= 0, down, node)
        total = np.zeros(len(bins))
        for values in value[node].reshape(len(trees), -1):
            total += values
        return total

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.base + self.margin(bins)


def cells(vector: Column) -> Column:
    """Struct (indices, values) of a sparse vector."""
    return F.unwrap_udt(vector)


def quantile_edges(cells: DataFrame, features: int, most: int) -> list[np.ndarray]:
    """At most ``most`` - 2 distinct quantiles of each feature's counts: values where a share i / (``most`` - 1) of them is reached.

    Equal counts are added up before the shuffle, so it moves the distinct ones only.
    """
    counted = cells.select(F.inline(F.arrays_zip("indices", "values"))).groupBy("indices", "values").agg(F.count("*").alias("n"))
    feature = Window.partitionBy("indices")
    upto, whole = F.sum("n").over(feature.orderBy("values")), F.sum("n").over(feature)
    placed = counted.select("indices", "values", "n", upto.alias("upto"), whole.alias("whole"))

    def reached(count: Column) -> Column:
        return F.least(F.floor(count * (most - 1) / F.col("whole")), F.lit(most - 2))

    rows = placed.where(reached(F.col("upto")) > reached(F.col("upto") - F.col("n"))).groupBy("indices").agg(
        F.array_sort(F.collect_list("values")).alias("at")).collect()
    out = [np.empty(0)] * features
    for row in rows:
        out[row["indices"]] = np.array(row["at"])
    return out


def block_of(batch: pa.RecordBatch, index: str, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat indices, flat values, and the row of each."""
    lists = batch.column(index)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return flat(index), flat(value), np.repeat(np.arange(len(sizes)), sizes)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            # Taken, not sliced, so that the offsets of lists begin at 0.
            yield batch.take(pa.array(range(first, min(first + ROWS_AT_ONCE, batch.num_rows))))


def _binned(model):
    """(price, held, indices, values) to rows with bin numbers and the base as margin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in slices(batches):
            index, values, row = block_of(batch, "indices", "values")
            bins = fitted.bins(index, values, row, batch.num_rows)[row, index]
            ends = batch.column("indices").offsets.to_numpy()
            packed = [_packed(index.astype(_index_type(len(fitted.edges))), ends), _packed(bins, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("price"), batch.column("held"), *packed, pa.array(np.full(batch.num_rows, fitted.base))],
                names=["price", "held", "indices", "bins", "margin"])
    return run


def _index_type(features: int) -> np.dtype:
    return np.dtype(np.uint16 if features <= 1 << 16 else np.uint32)


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Each row's cells as bytes, which pass from and to the workers whole and not cell by cell."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Flat values, and the number of each row."""
    _, ends, data = column.cast(pa.binary()).buffers()
    ends = np.frombuffer(ends, np.int32)[:len(column) + 1]
    return np.frombuffer(data or b"", np.uint8)[:ends[-1]].view(kind), np.diff(ends) // kind.itemsize


def _dense(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    index, sizes = _unpacked(batch.column("indices"), _index_type(features))
    bins, row = _unpacked(batch.column("bins"), np.dtype(np.uint8))[0], np.repeat(np.arange(batch.num_rows), sizes)
    block = np.zeros((batch.num_rows, features), np.uint8)
    block[row, index] = bins
    return block, index, bins, row


def _with_margin(model, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in slices(batches):
            more = fitted.margin(_dense(batch, len(fitted.edges))[0], first)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(batch.column("margin").to_numpy() + more)], names=batch.schema.names)
    return run


def _histograms(state, first: int, level: int, parts: int):
    """Per task: sums of gradients and numbers of rows (the hessian of half a squared error) by key, and at the root the errors.

    Keys count the nodes of the level, times the bins of all features and one more cell for the node as a whole. They come packed,
    a row for each of ``parts`` equal ranges of keys.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, tree, wanted = state.value
        starts = np.cumsum([0, *(len(e) + 1 for e in fitted.edges)])
        width, top = int(starts[-1]) + 1, (1 << level) - 1
        sums, counts = (np.zeros((1 << level) * width, np.int64) for _ in range(2))
        errors = np.zeros(3, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def count(least: int) -> None:
            if sum(len(keys) for keys, _ in waiting) < least:
                return
            keys, weights = map(np.concatenate, zip(*waiting))
            np.add(sums, np.bincount(keys, weights, len(sums)).astype(np.int64), out=sums)
            np.add(counts, np.bincount(keys, minlength=len(counts)), out=counts)
            waiting.clear()

        for batch in slices(batches):
            block, index, bins, row = _dense(batch, len(fitted.edges))
            rest = batch.column("margin").to_numpy() + fitted.margin(block, first) - batch.column("price").to_numpy()
            held = batch.column("held").to_numpy(zero_copy_only=False)
            square = np.rint(rest * ERROR).astype(np.int64) ** 2
            errors += [square[~held].sum(), square[held].sum(), held.sum()]
            node = tree.leaf_of(block, level) - top
            taking = ~held & (node >= 0) & wanted[node]
            gradient = np.rint(rest * GRADIENT)
            key = node * width + width - 1
            cell = taking[row]
            inside = row[cell]
            keys = np.concatenate([key[taking], node[inside] * width + starts[index[cell]] + bins[cell] - 1])
            weights = np.concatenate([gradient[taking], gradient[inside]])
            waiting.append((keys, weights))
            count(max(len(sums), CELLS_AT_ONCE))
        count(1)
        found = np.flatnonzero(counts)
        extra = [TRAIN_ERROR, HELD_ERROR, HELD_ROWS] if level == 0 else []
        keys = np.concatenate([extra, found]).astype(np.int64)
        part = np.maximum(keys, 0) * parts // len(sums)
        ends = np.searchsorted(part, np.arange(parts + 1))
        columns = keys, np.concatenate([errors[:len(extra)], sums[found]]), np.concatenate([np.zeros(len(extra), np.int64), counts[found]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(parts, dtype=np.int32)), *(_packed(x, ends) for x in columns)], names=["part", "keys", "totals", "counts"])
    return run


def _columns(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """Keys, totals and counts of each row that has some; no key comes twice in a row."""
    for row in zip(*(table.column(name) for name in ("keys", "totals", "counts"))):
        if len(row[0].as_py()):
            yield tuple(np.frombuffer(x.as_py(), np.int64) for x in row)


def _added(table: pa.Table) -> pa.Table:
    """One row for the rows of a range: each key once, with what these hold for it."""
    rows = list(_columns(table))
    first = min((keys.min() for keys, _, _ in rows), default=0)
    size = max((keys.max() + 1 for keys, _, _ in rows), default=0) - first
    totals, counts, there = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
    for keys, total, count in rows:
        totals[keys - first] += total
        counts[keys - first] += count
        there[keys - first] = True
    found = np.flatnonzero(there)
    packed = [[x.tobytes()] for x in (found + first, totals[found], counts[found])]
    return pa.table([pa.array(table.column("part").slice(0, 1).to_pylist(), pa.int32()), *(pa.array(x, pa.binary()) for x in packed)], names=["part", "keys", "totals", "counts"])


def _grow(tree: Tree, level: int, sums: np.ndarray, counts: np.ndarray, starts: np.ndarray, rate: float, penalty: float, least: int) -> np.ndarray:
    """Split the nodes of a level where that gains, and value both sides; tells the smaller child of each. ``sums`` and ``counts`` are (node, cell)."""
    top, smaller = (1 << level) - 1, np.zeros(2 << level, bool)
    for node in np.flatnonzero(counts[:, -1]):
        whole_g, whole_n = sums[node, -1] / GRADIENT, counts[node, -1]
        g, n = sums[node, :-1] / GRADIENT, counts[node, :-1]
        # Running sums within each feature; what lies in no bin has a count of 0 and goes left of all.
        running_g, running_n = np.cumsum(g), np.cumsum(n)
        before = np.concatenate([[0], running_g])[starts[:-1]], np.concatenate([[0], running_n])[starts[:-1]]
        after = np.concatenate([[0], running_g])[starts[1:]], np.concatenate([[0], running_n])[starts[1:]]
        sizes = np.diff(starts)
        zero_g, zero_n = whole_g - (after[0] - before[0]), whole_n - (after[1] - before[1])
        feature = np.repeat(np.arange(len(sizes)), sizes)
        # Cell c of a feature stands for the split below it.
        left_g = zero_g[feature] + running_g - g - before[0][feature]
        left_n = zero_n[feature] + running_n - n - before[1][feature]
        right_g, right_n = whole_g - left_g, whole_n - left_n
        gain = left_g ** 2 / (left_n + penalty) + right_g ** 2 / (right_n + penalty) - whole_g ** 2 / (whole_n + penalty)
        gain[(left_n < least) | (right_n < least)] = -np.inf
        best = int(np.argmax(np.round(gain, 6))) if len(gain) else 0
        if len(gain) and gain[best] > 1e-6:
            tree.feature[top + node], tree.bin[top + node] = feature[best], best - starts[feature[best]]
            tree.gain[top + node] = gain[best]
            smaller[2 * node + (right_n[best] < left_n[best])] = True
            below = 2 * (top + node) + 1
            tree.value[below] = -rate * left_g[best] / (left_n[best] + penalty)
            tree.value[below + 1] = -rate * right_g[best] / (right_n[best] + penalty)
    return smaller


def fit_boosted_trees(
    rows: DataFrame, features: int, rounds: int = 1000, rate: float = 0.1, depth: int = 6, penalty: float = 1.0, least: int = 1,
    most_bins: int = 32, patience: int | None = None,
) -> BoostedTrees:
    """Boost trees on ``rows`` (price, held, indices, values), whose ``held`` rows only measure.

    Newton steps on half the squared error: a leaf's value is the sum of its gradients over its rows plus ``penalty``, a split's
    gain the drop of that objective. With ``patience``, and held rows, the fit ends once so many rounds in a row have not
    lowered the held-out error, and keeps the trees up to the lowest; else all ``rounds`` are fitted. The result is the same at any partitioning.
    """
    if depth < 1:
        raise ValueError("a tree needs a split")
    spark = rows.sparkSession
    ship_package(spark)
    with scratch(spark):
        partitions = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        # Dealt evenly, as few files would keep few tasks busy.
        rows = stage(rows.repartition(partitions), "boosting-cells")
        mean = rows.where("not held").agg(F.avg("price")).first()[0]
        model = BoostedTrees(quantile_edges(rows.where("not held"), features, most_bins), float(mean or 0.0), depth)
        starts = np.cumsum([0, *(len(e) + 1 for e in model.edges)])
        width = int(starts[-1]) + 1
        schema = "price double, held boolean, indices binary, bins binary, margin double"
        data = stage(rows.mapInArrow(_binned(spark.sparkContext.broadcast(model)), schema), "boosting-rows").coalesce(partitions).persist()
        first, best = 0, (np.inf, 0)

        def level_sums(tree: Tree, level: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
            state = spark.sparkContext.broadcast((model, tree, wanted))
            sums, counts = (np.zeros((1 << level) * width, np.int64) for _ in range(2))
            parts = min(1 + len(sums) * partitions // CELLS_SUMMED, spark.sparkContext.defaultParallelism)
            found = data.mapInArrow(_histograms(state, first, level, parts), _SUMS).groupBy("part").applyInArrow(_added, _SUMS).toArrow()
            state.unpersist()
            errors: dict[int, int] = {}
            for key, total, n in _columns(found):
                cell = key >= 0
                sums[key[cell]], counts[key[cell]] = total[cell], n[cell]
                errors |= dict(zip(key[~cell].tolist(), total[~cell].tolist()))
            return sums.reshape(-1, width), counts.reshape(-1, width), errors

        while True:
            tree, grown, wanted, parents = Tree.of_depth(depth), True, np.ones(1, bool), None
            for level in range(depth):
                sums, counts, errors = level_sums(tree, level, wanted)
                if parents is not None:
                    for node in np.flatnonzero(wanted):
                        for all_nodes, whole in zip((sums, counts), parents):
                            all_nodes[node ^ 1] = whole[node >> 1] - all_nodes[node]
                else:
                    train, held = max(int(counts[0, -1]), 1), errors.get(HELD_ROWS, 0)
                    model.errors.append(((errors.get(TRAIN_ERROR, 0) / train) ** 0.5 / ERROR, (errors[HELD_ERROR] / held) ** 0.5 / ERROR if held else None))
                    if held and model.errors[-1][1] < best[0]:
                        best = model.errors[-1][1], model.rounds
                    if model.rounds == rounds or patience and held and model.rounds - best[1] >= patience:
                        grown = False
                        break
                wanted, parents = _grow(tree, level, sums, counts, starts, rate, penalty, least), (sums, counts)
                if not wanted.any():
                    grown = level > 0
                    break
            if not grown:
                break
            model.trees.append(tree)
            if model.rounds - first >= TREES_AT_ONCE:
                shared = spark.sparkContext.broadcast(model)
                more = stage(data.mapInArrow(_with_margin(shared, first), schema), "boosting-rows").coalesce(partitions).persist()
                data.unpersist()
                data, first = more, model.rounds
        data.unpersist()
    if patience and best[0] < np.inf:
        # One tree stays even if none has lowered the error.
        rounds = max(best[1], 1)
        model.trees, model.errors = model.trees[:rounds], model.errors[:rounds + 1]
    return model


def with_trees(df: DataFrame, model: Bins, vector: str = "bow", output: str = "_prediction") -> DataFrame:
    """Add the prediction of boosted trees from a column of sparse counts."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predicted(indices: pd.Series, values: pd.Series) -> pd.Series:
        fitted, out = shared.value, []
        for first in range(0, len(indices), ROWS_AT_ONCE):
            index, value = indices[first:first + ROWS_AT_ONCE], values[first:first + ROWS_AT_ONCE]
            row = np.repeat(np.arange(len(index)), index.map(len))
            flat = [np.concatenate([np.empty(0), *x]) for x in (index, value)]
            out.append(fitted.predict(fitted.bins(flat[0].astype(np.int64), flat[1], row, len(index))))
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return df.withColumn(output, predicted(cells(F.col(vector))["indices"], cells(F.col(vector))["values"]))
