"""Steps rewritten to grow no faster than their input, against plain versions of themselves."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from pricewright.operators import boosting, features, forest, models, ranking
from pricewright.operators.ranges import range_counts
from pricewright_queries import views


sparse = F.udf(lambda v: Vectors.sparse(len(v), [(i, x) for i, x in enumerate(v) if x]), VectorUDT())


def plain_tree(rows, depth):
    """The best split of a node of (price, bins) rows by trying all, down to one row or ``depth``: each row's value."""
    prices = np.array([p for p, _ in rows])
    out = {i: prices.mean() for i in range(len(rows))}
    best = (1e-6, None)
    if depth:
        for f in range(len(rows[0][1])):
            for cut in sorted({bins[f] for _, bins in rows})[:-1]:
                left = np.array([bins[f] <= cut for _, bins in rows])
                gain = sum(s.sum() * (prices[s].mean() - prices.mean()) ** 2 for s in (left, ~left))
                if gain > best[0] + 1e-9:
                    best = (gain, left)
    if best[1] is not None:
        for side in (best[1], ~best[1]):
            at = np.flatnonzero(side)
            for i, value in plain_tree([rows[k] for k in at], depth - 1).items():
                out[int(at[i])] = value
    return out


@pytest.mark.parametrize("depth", [1, 3, 30])
def test_tree_equals_the_plain_one(depth):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 4, (60, 5)) * (rng.random((60, 5)) < 0.6)
    price, copies = rng.integers(100, 9000, 60) / 10, rng.integers(1, 4, 60)
    row, index = np.nonzero(bins)
    tree = forest.grow_tree(price, copies, row, index, bins[row, index], depth)
    fitted = forest.Forest([np.arange(4.0)] * 5, 0.0, np.array([0]), tree["feature"], tree["bin"], tree["below"], tree["value"], tree["gain"])
    origin = np.repeat(np.arange(60), copies)
    want = plain_tree([(price[i], tuple(bins[i])) for i in origin], depth)
    assert fitted.predict(bins)[origin] == pytest.approx([want[i] for i in range(len(origin))], abs=1e-3)


def test_forest_takes_no_pass_per_node(spark):
    """Trees of the full depth, of some hundred nodes each, in as few jobs as trees of one split; rows without words and without trees."""
    rows = [(i, 50.0 + (i * 7919 % 900), " ".join(f"word{chr(97 + j)}" for j in range(12) if i >> j & 1), None, 0.0) for i in range(500)]
    df = spark.createDataFrame(rows, "product_id bigint, price double, text string, summary string, weight double")
    terms = features.vocabulary_terms(features.bow_vocabulary(features.bow_tokens(df)))

    def jobs(depth):
        spark.sparkContext.setJobGroup(f"forest-{depth}", "")
        fit = models.random_forest(df, terms, trees=8, depth=depth)
        spark.sparkContext.setJobGroup("", "")
        return fit, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest-{depth}"))

    (short, few), (deep, many) = jobs(1), jobs(30)
    assert many <= few + 1 and len(short.model.feature) == 24 and len(deep.model.feature) > 8 * 300
    error = deep.predict(df).agg(F.avg(F.abs(F.col("predicted") - F.col("price")))).first()[0]
    assert error < 150 and sum(deep.model.featureImportances) == pytest.approx(1)
    none = models.random_forest(df.where("product_id < 0"), terms, trees=3)
    assert none.predict(df).where("predicted = 0").count() == 500


def test_forest_learns_from_all_rows(spark):
    """A word that stands in rows beyond the first 15,000 in shuffled order only, and decides their price."""
    ids = spark.range(15_300).withColumnRenamed("id", "product_id")
    first = ranking.head_subset(ids, 15_000).withColumn("first", F.lit(True))
    df = ids.join(first, "product_id", "left").select(
        "product_id", F.when(F.col("first"), 100.0).otherwise(900.0).alias("price"), F.when(F.col("first"), "early").otherwise("late").alias("text"),
        F.lit(None).cast("string").alias("summary"), F.lit(0.0).alias("weight"))
    fit = models.random_forest(df, ["early", "late"], trees=3)
    assert {tuple(r) for r in fit.predict(df).select("text", "predicted").distinct().collect()} == {("early", 100.0), ("late", 900.0)}
    few = models.random_forest(df, ["early", "late"], rows=15_000, trees=3)
    assert few.predict(df).where("predicted <> 100").count() == 0


def test_tops_of_trees_do_not_change_them(spark, monkeypatch):
    """Trees whose upper nodes passes have split, at any depth of these, are those that a task grows from the root."""
    draw = random.Random(4)
    words = [f"word{chr(97 + j)}" for j in range(9)]
    rows = [(i, draw.randrange(100, 9000) / 10, " ".join(" ".join([w] * draw.choice([0, 0, 0, 1, 2, 5])) for w in words), None, 0.0) for i in range(150)]
    df = spark.createDataFrame(rows, "product_id bigint, price double, text string, summary string, weight double").cache()

    def grown(cells, depth):
        monkeypatch.setattr(forest, "NODE_CELLS", cells)
        pricer = models.random_forest(df, words, trees=3, depth=depth)
        whole = pricer.model.whole

        def tree(node):
            if whole.feature[node] < 0:
                return whole.value[node]
            below = whole.below[node]
            return int(whole.feature[node]), int(whole.bin[node]), whole.gain[node], tree(below), tree(below + 1)

        pieces = pricer.model.pieces.where("node >= 0").selectExpr("count(*)", "coalesce(max(size(value)), 0)").first()
        return [tree(root) for root in whole.roots], {r.product_id: r.predicted for r in pricer.predict(df).collect()}, tuple(pieces)

    for depth, cells in ((5, 200), (3, 1)):
        trees, predicted, pieces = grown(1 << 21, depth)
        more_trees, more_predicted, more = grown(cells, depth)
        assert more_trees == trees and more_predicted == predicted and pieces[0] == 3 and more[1] < pieces[1]
    # No node of more rows than the limit reached a task.
    assert more[1] <= 1


def test_bags_are_drawn_with_mean_one():
    hashed = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, 200_000)
    copies = [forest.draws(hashed, tree) for tree in range(3)]
    for drawn in copies:
        shares = np.bincount(drawn, minlength=4)[:4] / len(hashed)
        assert shares == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6]), abs=5e-3)
    assert abs(np.corrcoef(copies)[np.triu_indices(3, 1)]).max() < 0.01
    assert (forest.draws(hashed[::-1], 2) == copies[2][::-1]).all()


def test_a_stored_forest_predicts_as_one_of_the_driver(spark, monkeypatch):
    """Trees in groups and the vectors by their digests: as all trees at once, for rows that repeat, ids that are null and rows without words."""
    rows = [(i if i % 5 else None, 50.0 + (i * 7919 % 900), [1.0 * (i >> j & 3) for j in range(7)]) for i in range(90)] * 2
    df = spark.createDataFrame(rows, "product_id bigint, price double, many array<double>")
    df = df.withColumn("bow", array_to_vector("many")).withColumn("bow", sparse("bow")).drop("many")
    for held in (forest.NODES_HELD, 1):
        monkeypatch.setattr(forest, "NODES_HELD", held)
        pricer = models.random_forest(df, [f"word{j}" for j in range(7)], trees=11)
        assert pricer.model.groups == (4 if held > 1 else 11)
        want = []
        for r in df.collect():
            index, values = np.array(r.bow.indices, np.int64), np.array(r.bow.values)
            want.append((r.product_id or -1, r.price, pricer.model.whole.predict(pricer.model.bins(index, values, np.zeros(len(index), np.int64), 1))[0]))
        got = [(r.product_id or -1, r.price, r.predicted) for r in pricer.predict(df).collect()]
        assert [x[:2] for x in sorted(got)] == [x[:2] for x in sorted(want)]
        assert [x[2] for x in sorted(got)] == pytest.approx([x[2] for x in sorted(want)], abs=1e-5)


def test_counts_of_ranges_make_no_pairs(spark):
    """As by hand, at any width: ends on, between and beyond the points, repeated ranges, nulls, NaN; and 300 million pairs that are not made."""
    draw = random.Random(3)
    prices = [draw.choice([None, float("nan"), float("inf"), -3.5, 42.0, 42.0, draw.uniform(-50, 900)]) for _ in range(300)]
    ranges = [(j, low, low + draw.choice([0.0, 1.0, 7.0, 300.0, 5000.0])) for j in range(80) for low in [float(draw.randrange(-60, 950))]] * 2
    ranges += [(500, 42.0, 42.0), (501, None, 5.0), (502, 9.0, 1.0), (503, -1e9, 1e9), (504, 0.0, float("nan")), (505, 2000.0, 3000.0), (506, -90.0, -80.0),
               (507, 0.0, float("inf")), (None, 0.0, 50.0), (508, -3.5, 42.0)]
    left = spark.createDataFrame([(p,) for p in prices], "price double")
    right = spark.createDataFrame(ranges, "band int, low double, high double")

    def by_hand(given):
        out = []
        for band, a, b in ranges:
            inside = [p for p in given if None not in (p, a, b) and abs(b - a) < float("inf") and a <= p <= b]
            out.append((band, a, b, len(inside), min(inside, default=None), max(inside, default=None)))
        return sorted(map(str, out))

    for given, width in ((prices, 0.01), (prices, 64.0), ([42.0], 1.0), ([], 1.0)):
        got = range_counts(left.where("price = 42").limit(len(given)) if len(given) < 2 else left, right, "price", "low", "high", width)
        assert sorted(str(tuple(r)) for r in got.collect()) == by_hand(given)
    many = spark.range(20_000).select((F.col("id") / 100).alias("price")), spark.range(20_000).selectExpr("id as band", "0.0D as low", "id * 1.0D as high")
    counts = range_counts(*many, "price", "low", "high", 0.01)
    assert counts.agg(F.sum("items")).first()[0] > 300_000_000
    assert counts.where("band = 7").select("items", "least", "most").collect() == [(701, 0.0, 7.0)]


def test_texts_move_once_to_split_and_summary(spark, tmp_path, monkeypatch):
    """Ids that repeat get a place each, and every summary of their id, as before; positions are settled without the texts."""
    text = "Some words of a long text. " * 20
    ids = [*range(30), 8, 8, 12]
    tables = {
        "documents": spark.createDataFrame([(i, f"{k} {text}") for k, i in enumerate(ids)], "doc_id bigint, text string"),
        "events": spark.range(30).selectExpr("id as event_id", "10.0D + id as value"),
        "part": spark.range(30).selectExpr("id as p_partkey", "'brand' as p_brand", "5 as p_size"),
        "labels": spark.createDataFrame([(8,), (8,), (3,), (None,)], "doc_id bigint"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    stored, stage = {}, views.stage
    monkeypatch.setattr(views, "stage", lambda df, label: stage(stored.setdefault(label, df), label))
    prepared = views.prepared(spark, str(tmp_path))
    plan = stored["prepared"]._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("text#" in below for line, below in zip(plan, plan[1:]) if "Exchange hashpartitioning(_bucket" in line)
    assert prepared.columns == [c for c in views.product_split(spark, str(tmp_path)).columns if c != "summary"] + ["summary"]
    was = views.product_split(spark, str(tmp_path)).drop("summary").join(views.summaries(spark, str(tmp_path)), "product_id", "left").collect()
    now = prepared.collect()
    for columns in (("product_id", "split", "pos"), ("product_id", "text", "price", "summary")):
        assert Counter(tuple(r[c] for c in columns) for r in now) == Counter(tuple(r[c] for c in columns) for r in was)
    assert sum(r.product_id == 8 for r in now) == 9 and len({(r.split, r.pos) for r in now}) == len(now) - 6


def test_smaller_children_are_summed_and_all_trees_descended_at_once():
    tree = boosting.Tree.of_depth(2)
    # Two features of two bins: the first parts 9 rows from 1, the second gains nothing.
    sums, counts = np.array([[90_000, -90_000, 0, 0, 0]]), np.array([[9, 1, 5, 5, 10]])
    smaller = boosting._grow(tree, 0, sums, counts, np.array([0, 2, 4]), 1.0, 0.0, 1)
    assert smaller.tolist() == [False, True] and tree.feature[0] == 0
    rng = np.random.default_rng(1)
    trees = []
    for _ in range(5):
        made = boosting.Tree.of_depth(3)
        made.feature[:7], made.bin[:7], made.value[:] = rng.integers(-1, 4, 7), rng.integers(0, 3, 7), rng.random(15)
        trees.append(made)
    model, bins = boosting.BoostedTrees([np.arange(3.0)] * 4, 0.0, 3, trees), rng.integers(0, 4, (50, 4)).astype(np.uint8)
    for first in (0, 2, 5):
        assert model.margin(bins, first).tolist() == sum((t.value[t.leaf_of(bins, 3)] for t in trees[first:]), np.zeros(50)).tolist()


def test_cells_pass_packed():
    rows = [[1, 300, 65_535], [], [7]]
    ends, flat = np.cumsum([0, *map(len, rows)]), np.array(sum(rows, []))
    for kind in (np.dtype(np.uint16), np.dtype(np.uint32)):
        values, sizes = boosting._unpacked(boosting._packed(flat.astype(kind), ends).take(pa.array([1, 0, 2])), kind)
        assert values.tolist() == [1, 300, 65_535, 7] and sizes.tolist() == [0, 3, 1]
    assert boosting._unpacked(boosting._packed(flat[:0].astype(np.uint16), np.zeros(3, int)), np.dtype(np.uint16))[0].size == 0


def test_a_tree_sums_only_what_the_smaller_children_hold(monkeypatch):
    """Many levels that part a few rows from the rest: below the root the cells of those few are summed, not all at every level."""
    rows, words = 64, 40
    row, index = map(np.ravel, np.meshgrid(np.arange(rows), np.arange(words), indexing="ij"))
    here = (index == 0) | (row < index)
    row, index = row[here], index[here]
    price, bins = 1.5 ** np.arange(rows)[::-1].clip(20), np.ones(len(row), np.int64)
    summed, runs = [], forest._runs
    monkeypatch.setattr(forest, "_runs", lambda node, *rest: summed.append(len(node)) or runs(node, *rest))
    tree = forest.grow_tree(price, np.ones(rows, np.int64), row, index, bins, 30)
    assert len(summed) > 10 and summed[0] == len(row) and sum(summed[1:]) < 2 * len(row)
    fitted = forest.Forest([np.arange(2.0)] * words, 0.0, np.array([0]), tree["feature"], tree["bin"], tree["below"], tree["value"], tree["gain"])
    block = np.zeros((rows, words), np.uint8)
    block[row, index] = 1
    assert fitted.predict(block)[:20] == pytest.approx(price[:20], rel=1e-3)


def test_quantiles_are_exact_at_any_partitioning(spark):
    draw = random.Random(8)
    rows = [([0, 2], [float(draw.randrange(1, 40)), float(draw.choice([1, 1, 1, 2]))]) for _ in range(700)] + [([], []), ([0], [3.0])]
    given = spark.createDataFrame(rows, "indices array<int>, values array<double>")
    for most in (3, 16, 32):
        want = []
        for word in range(4):
            found = sorted(v for index, values in rows for i, v in zip(index, values) if i == word)
            want.append(sorted({found[-(-i * len(found) // (most - 1)) - 1] for i in range(1, most - 1)} if found else set()))
        for parts in (1, 7):
            assert [e.tolist() for e in boosting.quantile_edges(given.repartition(parts), 4, most)] == want


def test_what_tasks_found_is_added_up_by_ranges_of_cells():
    """In any number of ranges, the sums of the rows; cells that no task found are not there."""
    edges = [np.array([1.0, 2.0]), np.array([1.0])]
    model, tree = boosting.BoostedTrees(edges, 0.0, 2), boosting.Tree.of_depth(2)
    ends = np.array([0, 2, 2, 3])
    batch = pa.record_batch([
        pa.array([10.0, 20.0, 30.0]), pa.array([False, False, True]), boosting._packed(np.array([0, 1, 0], np.uint16), ends),
        boosting._packed(np.array([3, 1, 1], np.uint8), ends), pa.array([1.0, 2.0, 5.0])], names=["price", "held", "indices", "bins", "margin"])
    state = type("State", (), {"value": (model, tree, np.ones(1, bool))})
    want = {2: (-90_000, 1), 3: (-90_000, 1), 5: (-270_000, 2), boosting.TRAIN_ERROR: ((81 + 324) * 256, 0), boosting.HELD_ERROR: (625 * 256, 0), boosting.HELD_ROWS: (1, 0)}
    for parts in (1, 2, 5):
        made = pa.concat_tables([pa.Table.from_batches(boosting._histograms(state, 0, 0, parts)(iter([batch]))) for _ in range(3)])
        assert made.num_rows == 3 * parts
        added = [boosting._added(made.filter(pa.compute.equal(made["part"], part))) for part in range(parts)]
        got = {k: (t, n) for table in added for columns in boosting._columns(table) for k, t, n in zip(*(x.tolist() for x in columns))}
        assert got == {key: (3 * total, 3 * n) for key, (total, n) in want.items()}


def test_learners_share_counts_that_are_there(spark):
    """Rows with counts and no text give the fits and the predictions that their texts give."""
    rows = [(i, 20.0 + 50 * (i % 3) + i % 7, "cable " * (i % 3) + " ".join(f"word{chr(97 + j)}" for j in range(5) if i >> j & 1), None, 0.0) for i in range(120)]
    texts = spark.createDataFrame(rows, "product_id bigint, price double, text string, summary string, weight double")
    terms = features.vocabulary_terms(features.bow_vocabulary(features.bow_tokens(texts)))
    counts = features.bow_vectors(features.bow_tokens(texts), terms).select("product_id", "price", "bow")
    for fit, options in ((models.linear_bow, {}), (models.random_forest, {"trees": 4}), (models.boosted_trees, {"rounds": 4})):
        of_texts, of_counts = fit(texts, terms, **options), fit(counts, terms, **options)
        want = {r.product_id: r.predicted for r in of_texts.predict(texts).collect()}
        for pricer, given in ((of_counts, counts), (of_counts, texts), (of_texts, counts)):
            predicted = pricer.predict(given)
            assert predicted.columns == [*given.columns, "predicted"]
            assert {r.product_id: r.predicted for r in predicted.collect()} == pytest.approx(want)
