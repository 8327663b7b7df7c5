"""Operators on small tables, against brute force in Python."""

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from pricewright.constants import CATEGORY_MULTIPLIERS
from pricewright.operators import cleaning, dealing, dedup, evaluation, profiling, prompting, ranking, sampling, splitting
from pricewright.schemas import PRODUCT, RAW_LISTING


def bits(key, seed=42):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16)


def products(spark, rows):
    """rows of (id, title, category, price, text)"""
    return spark.createDataFrame(
        [(i, title, category, float(price), text, 0.0, None) for i, title, category, price, text in rows], PRODUCT)


def raw(spark, **fields):
    row = {"product_id": 1, "title": "t", "category": "c", "price": "$5", "description": ["x" * 400],
           "features": ["f"], "details": "{}"}
    row.update(fields)
    return spark.createDataFrame([tuple(row[f] for f in RAW_LISTING.fieldNames())], RAW_LISTING)


# Cleaning

@pytest.mark.parametrize("length,kept", [(299, 0), (300, 1)])
def test_minimum_text(spark, length, kept):
    # "t x... f {}" has 7 characters around the description.
    listing = raw(spark, description=["x" * (length - 7)])
    assert cleaning.clean_items(listing).count() == kept
    reason = cleaning.label_rejects(listing).first().reject_reason
    assert reason == (None if kept else cleaning.SHORT_TEXT)


def test_text_is_cut_after_everything_else(spark):
    listing = raw(spark, title="B07XJ8C8F5", description=["y" * 5000])
    row = cleaning.clean_items(listing, max_length=4000).first()
    assert row.text == " " + "y" * 3999
    assert cleaning.clean_items(listing).first().text == " " + "y" * 5000 + " f {}"


def test_reject_reasons_come_in_order(spark):
    for price, reason in [("", cleaning.BAD_PRICE), ("1-2", cleaning.BAD_PRICE), ("0.49", cleaning.OUT_OF_RANGE),
                          ("1,000", cleaning.OUT_OF_RANGE)]:
        assert cleaning.label_rejects(raw(spark, price=price, description=[])).first().reject_reason == reason


def test_nulls_in_a_listing(spark):
    listing = raw(spark, title=None, description=[None, "x" * 400, None], features=None, details=None)
    row = cleaning.clean_items(listing).first()
    assert (row.title, row.text, row.weight, row.summary) == ("", "x" * 400 + " {}", 0.0, None)


def test_description_as_plain_string(spark):
    listing = raw(spark).withColumn("description", F.lit("z" * 400))
    assert cleaning.clean_items(listing).first().text == "t " + "z" * 400 + " f {}"


def test_cleaning_report_of_nothing(spark):
    assert cleaning.price_validity_report(raw(spark).where("false")).first().asDict() == {
        "total": 0, "valid": 0, "invalid": 0, "out_of_range": 0, "valid_pct": None, "invalid_pct": None, "out_of_range_pct": None}


def test_text_is_evaluated_once(spark):
    plan = cleaning.clean_items(raw(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("{7}") == 1 and plan.count("Generate") == 2
    # The details are parsed for their text and for the weight in one place.
    assert plan.count("from_json(ArrayType(MapType(") == 1


# Ranking

def test_positions_are_the_shuffled_order(spark):
    ids = list(range(3000))
    df = spark.createDataFrame([(i,) for i in ids], "product_id bigint")
    got = {r.product_id: r.pos for r in ranking.with_position(df).collect()}
    order = sorted(ids, key=lambda i: (bits(i), i))
    assert got == {key: place for place, key in enumerate(order)}
    again = {r.product_id: r.pos for r in ranking.with_position(df.repartition(13)).collect()}
    assert again == got
    shuffled = [r.product_id for r in ranking.shuffle_rows(df).collect()]
    assert shuffled == order


@pytest.mark.parametrize("count", [0, 5, 1000, 1001, 2500, 3000, 4000])
def test_head_subset_is_exact(spark, count):
    df = spark.range(3000).withColumnRenamed("id", "product_id")
    got = {r.product_id for r in ranking.head_subset(df, count).collect()}
    assert got == set(sorted(range(3000), key=lambda i: (bits(i), i))[:count])


@pytest.mark.parametrize("count", [5, 10, 999, 1000, 1001, 3000, 4000])
def test_null_keys_come_first_at_every_count(spark, count):
    ids = [None if i % 300 == 7 else i for i in range(3000)]
    df = spark.createDataFrame([(i,) for i in ids], "product_id bigint")
    got = [r.product_id for r in ranking.head_subset(df, count).collect()]
    known = sorted((i for i in ids if i is not None), key=lambda i: (bits(i), i))
    assert len(got) == min(count, 3000) and got.count(None) == min(count, 10)
    assert {i for i in got if i is not None} == set(known[:max(0, count - 10)])


def test_positions_keep_null_keys(spark):
    df = spark.createDataFrame([(None if i < 10 else i,) for i in range(3000)], "product_id bigint")
    rows = ranking.with_position(df).collect()
    assert sorted(r.pos for r in rows) == list(range(3000))
    assert {r.pos for r in rows if r.product_id is None} == set(range(10))
    assert splitting.split_dataset(df).count() == 3000


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0] * 7, [3.0, -1.0, -1.0, 0.0], [1e-9, 1e9, -1e9, 0.5], [float(i % 17) for i in range(1000)],
])
def test_upper_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert ranking.upper_median(df, F.col("v")).first()[0] == sorted(values)[len(values) // 2]
    assert ranking.upper_median(df.where("false"), F.col("v")).count() == 0


def test_buckets_never_fall(spark):
    draw = random.Random(3)
    values = sorted([draw.uniform(-5, 5) * 10 ** draw.randint(-8, 8) for _ in range(5000)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.b for r in df.select("i", ranking.value_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)
    positive = [v for v in values if v > 0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(positive)], "i int, v double")
    got = [r.b for r in df.select("i", ranking.log_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


# De-duplication

def brute_dedup(rows):
    seen_titles, seen_texts, kept = set(), set(), set()
    first = [r for r in sorted(rows, key=lambda r: (bits(r[0]), r[0])) if not (r[1] in seen_titles or seen_titles.add(r[1]))]
    for r in first:
        if r[4] not in seen_texts:
            seen_texts.add(r[4])
            kept.add(r[0])
    return len(first), kept


def test_dedup_with_a_hot_title(spark):
    draw = random.Random(1)
    rows = [(i, "" if i % 3 == 0 else f"title {draw.randint(0, 60)}", "c", 1, f"text {draw.randint(0, 40)}") for i in range(600)]
    df = products(spark, rows)
    after_title, kept = brute_dedup(rows)
    for parts in (1, 7):
        got = {r.product_id for r in dedup.dedup_title_then_text(df.repartition(parts)).collect()}
        assert got == kept
    assert dedup.dedup_title(df).count() == after_title
    assert {r.product_id for r in dedup.dedup_text(dedup.dedup_title(df)).collect()} == kept
    assert dedup.dedup_report(df).first().asDict() == {"before": 600, "after_title": after_title, "after_text": len(kept)}


def test_missing_texts_are_no_copies(spark):
    rows = [(i, f"t{i}", "c", 1, None) for i in range(5)] + [(5, "a", "c", 1, ""), (6, "b", "c", 1, ""), (7, "x", "c", 1, "same"), (8, "y", "c", 1, "same")]
    df = products(spark, rows)
    assert dedup.dedup_text(df).count() == dedup.dedup_title_then_text(df).count() == 7
    assert dedup.dedup_report(df).first().after_text == 7
    # With summaries these tell copies from each other.
    told = df.withColumn("summary", F.when(F.col("product_id") < 2, "one summary").when(F.col("product_id") == 7, "another"))
    assert {r.product_id for r in dedup.dedup_text(told).collect()} >= {2, 3, 4, 7, 8}
    assert dedup.dedup_text(told).count() == 7


# Sampling

def catalogue(spark, n=4000):
    draw = random.Random(5)
    categories = ["Automotive"] * 3 + ["Tools_and_Home_Improvement"] * 2 + ["Electronics", "Appliances", "Unlisted"]
    rows = [(i, f"t{i}", draw.choice(categories), round(draw.uniform(0.5, 999), 2), "x") for i in range(n)]
    return rows, products(spark, rows)


def brute_sample(rows, count):
    prices = [r[3] for r in rows]
    low, high = min(prices), max(prices)
    keys = []
    for i, _, category, price, _ in rows:
        weight = ((price - low) / ((high - low) + 1e-9)) ** 2 * CATEGORY_MULTIPLIERS.get(category, 1.0)
        if weight > 0:
            keys.append((-math.log((bits(i) + 0.5) / 2**52) / weight, i))
    return {i for _, i in sorted(keys)[:count]}


@pytest.mark.parametrize("count", [1, 700, 1500, 3999, 820_000])
def test_weighted_sample_is_exact(spark, count):
    rows, df = catalogue(spark)
    got = [r.product_id for r in sampling.weighted_sample(df, count).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_sample(rows, count)


def test_weighted_sample_shares_follow_the_weights(spark):
    _, df = catalogue(spark)
    drawn = {r.category: r.items for r in sampling.sample_distribution(sampling.weighted_sample(df, 500)).collect()}
    assert drawn["Automotive"] < drawn["Electronics"]


def test_equal_prices_leave_nothing_to_draw(spark):
    df = products(spark, [(i, "t", "Electronics", 5, "x") for i in range(10)])
    assert sampling.weighted_sample(df, 5).count() == 0
    assert {r.probability for r in sampling.sampling_probability(df).collect()} == {None}
    assert sampling.weighted_sample(df.limit(1), 5).count() == 0


def test_a_draw_scans_its_table_few_times(spark, tmp_path):
    _, df = catalogue(spark, 200)
    df.write.parquet(str(tmp_path / "stored"))
    drawn = sampling.weighted_sample(spark.read.parquet(str(tmp_path / "stored")), 50)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    drawn.collect()
    executed = drawn._jdf.queryExecution().executedPlan().toString()
    assert plan.count("scalar-subquery") < 40
    assert executed.split("== Initial Plan ==")[0].count("Scan parquet") <= 12


def test_multipliers_as_table(spark):
    _, df = catalogue(spark, 200)
    table = spark.createDataFrame(list(CATEGORY_MULTIPLIERS.items()), "category string, multiplier double")
    by_map = {r.product_id: r.sampling_weight for r in sampling.category_weight(df).collect()}
    by_table = {r.product_id: r.sampling_weight for r in sampling.category_weight(df, table).collect()}
    assert by_map == by_table


def test_weight_report_omits_absent_and_unlisted(spark):
    _, df = catalogue(spark, 300)
    report = {r.category: r for r in sampling.weight_report(df).collect()}
    assert set(report) == {"Automotive", "Tools_and_Home_Improvement", "Electronics", "Appliances"}
    auto = report["Automotive"]
    assert auto.weight_after == pytest.approx(auto.weight_before * 0.05)


@pytest.mark.parametrize("n", [0, 1, 100, 1000])
def test_proportional_split(spark, n):
    df = spark.range(n).withColumnRenamed("id", "product_id")
    rows = splitting.split_dataset(df).collect()
    train, val = int(n * 0.9756), int(n * 0.9878)
    sizes = {"train": train, "val": val - train, "test": n - val}
    for split, size in sizes.items():
        assert sorted(r.pos for r in rows if r.split == split) == list(range(size))
    assert len({r.product_id for r in rows}) == n


@pytest.mark.parametrize("n,kept", [(99, 99), (100, 100), (150, 100)])
def test_fixed_split_drops_the_rest(spark, n, kept):
    rows = splitting.split_dataset(spark.range(n).withColumnRenamed("id", "product_id"), full_ends=(80, 90, 100)).collect()
    assert len(rows) == kept
    if n >= 100:
        assert [sum(r.split == s for r in rows) for s in ("train", "val", "test")] == [80, 10, 10]


# Prompts

def test_build_prompts(spark):
    rows = [(1, "train", 0, 2.5, "  hi  ", "text"), (2, "val", 0, 1.5, "", "text"), (3, "test", 0, 99.5, None, "w " * 120)]
    splits = spark.createDataFrame(rows, "product_id bigint, split string, pos bigint, price double, summary string, text string")
    got = {r.product_id: r for r in prompting.build_prompts(splits).collect()}
    head = "What does this cost to the nearest dollar?\n\n"
    assert got[1].prompt == head + "hi\n\nPrice is $2.00" and got[1].completion == "2.00"
    assert got[2].prompt == head + "text\n\nPrice is $2.00"
    assert got[3].prompt == head + "w " * 97 + "w\n\nPrice is $" and got[3].completion == "100.00"
    assert [got[i].truncated for i in (1, 2, 3)] == [False, False, True]
    report = {r.split: r for r in prompting.truncation_report(prompting.build_prompts(splits)).collect()}
    assert (report["test"].truncated_pct, report["test"].high, report["val"].high) == (100.0, True, False)


def test_word_stats_count_once_over_all_train_rows(spark):
    lengths = [3, 1, 4, 1, 5, 9, 2, 6]
    rows = [("train", 10_000 + i, "w " * n) for i, n in enumerate(lengths)] + [("val", 0, "w " * 99)]
    df = spark.createDataFrame(rows, "split string, pos bigint, prompt string")
    stats = prompting.prompt_word_stats(df)
    assert stats.first().asDict() == {"items": 8, "mean_words": sum(lengths) / 8, "median_words": sorted(lengths)[4], "max_words": 9}
    assert stats._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert prompting.prompt_word_stats(df.where("false")).first().asDict() == {"items": 0, "mean_words": None, "median_words": None, "max_words": None}
    bodies = spark.createDataFrame([("train", 90_000 + i, None, "a " * n) for i, n in enumerate(lengths)], "split string, pos bigint, summary string, text string")
    assert prompting.token_profile(bodies).first()["items"] == 8 and prompting.token_profile(bodies).first().max_tokens == 9


# Evaluation

def outputs(spark):
    rows = [(i, m, f"${(i * k) % 300}.5", float(i)) for i in range(500) for m, k in (("a", 1), ("b", 7), ("c", 3))]
    return rows, spark.createDataFrame(rows, "item_id bigint, model_name string, output string, actual double")


@pytest.mark.parametrize("size", [200, 10_000])
def test_every_model_meets_the_same_items(spark, size):
    rows, df = outputs(spark)
    chosen = set(sorted(range(500), key=lambda i: (bits(i), i))[:size])
    result = {r.model_name: r for r in evaluation.evaluate_models(df, sample_size=size).collect()}
    scored = evaluation.score(evaluation.sampled_outputs(df, sample_size=size)).orderBy("item_id").collect()
    for model in "abc":
        errors = [abs(float(o[1:]) - a) for i, m, o, a in sorted(rows) if m == model and i in chosen]
        assert result[model].sample_size == len(errors) == min(size, 500)
        assert result[model].mae == pytest.approx(sum(errors) / len(errors))
        assert [r.abs_error for r in scored if r.model_name == model] == pytest.approx(errors)


def test_leaderboard(spark):
    results = spark.createDataFrame([("x", 50.0), ("y", 200.0), ("z", 100.0)], "model_name string, mae double")
    board = evaluation.leaderboard(results).collect()
    assert [(r.model_name, r.gain) for r in board] == [("y", 0.0), ("z", 100.0), ("x", 150.0)]
    best = evaluation.leaderboard_summary(results).first()
    assert (best.best_model, best.gain, best.gain_pct) == ("x", 150.0, 75.0)
    compared = {r.model_name: r.gain_pct for r in evaluation.compare_to_baseline(results, "z").collect()}
    assert compared == {"x": 50.0, "y": -100.0, "z": 0.0}


def test_numeric_outputs_score_as_numbers(spark):
    df = spark.createDataFrame([(1, "m", 3.5, 5.0), (2, "m", None, 5.0)], "item_id bigint, model_name string, output float, actual double")
    assert sorted(r.abs_error for r in evaluation.score(df).collect()) == [1.5, 5.0]


# Deals and histograms

def test_weighted_ensemble_with_a_table(spark):
    estimates = spark.createDataFrame([(1, "p", 10.0), (1, "q", 20.0), (1, "unknown", 9.0)], "deal_id bigint, predictor string, estimate double")
    weights = {"p": 0.5, "q": 0.25}
    table = spark.createDataFrame(list(weights.items()), "predictor string, weight double")
    for given in (weights, table):
        assert dealing.weighted_ensemble(estimates, given).first().estimate == 10.0


def test_price_bins(spark):
    prices = [0.0, 19.99, 20.0, 979.99, 980.0, 980.01, 999.0]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    rows = profiling.price_histogram(df.unionByName(spark.createDataFrame([(None,), (-1.0,), (float("nan"),)], "price double"))).collect()
    bins = {r.bin: r.items for r in rows}
    assert len(bins) == 50 and bins[0] == 2 and bins[1] == 1 and bins[48] == 2
    assert bins[49] == 5 and sum(bins.values()) == len(prices) + 3
    assert [(r.low, r.high) for r in rows if r.bin == 49] == [(980, None)]


@pytest.mark.parametrize("values", [[5] * 9, [0, 50], list(range(51)), [3, 4, 4, 9, 27, 100, 101], [0.1 * i for i in range(77)]])
def test_equal_width_bins_equal_numpy(spark, values):
    import numpy

    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r.items for r in profiling.length_histogram(df, "v").orderBy("bin").collect()]
    assert got == numpy.histogram(values, bins=50)[0].tolist()
