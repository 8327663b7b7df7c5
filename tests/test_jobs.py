"""Stores, plans, models and the stream, end to end on small tables."""

import os
from types import SimpleNamespace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricewright_queries import views
from pricewright_queries.words import stop_words
from pricewright import session
from pricewright.operators import cleaning, dealing, dedup, features, ingest_dedup, models, splitting
from pricewright.operators.asof import asof_join
from pricewright.operators.ranges import range_join
from pricewright.plans.leaderboard import rank_pricers
from pricewright.plans.listings import publish_listings, split_listings
from pricewright.plans.prompts import publish_prompts
from pricewright.schemas import DEAL, RAW_LISTING
from pricewright.session import stage, stage_root
from pricewright.sources import catalog, datasets
from pricewright.streaming.deals import read_deals, read_scored, stream_alert_counts, stream_deals, stream_first_alerts


def test_stages_live_in_the_shared_folder(spark):
    assert stage_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5 and staged.inputFiles()[0].startswith("file://" + stage_root(spark))


def test_stages_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "stage_root", lambda spark: str(tmp_path))
    staged = stage(spark.range(5), "five")
    path = staged.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    session.drop_stages(spark)
    assert not os.path.exists(path)


def test_empty_categories_are_stored(spark, tmp_path):
    empty = spark.createDataFrame([], RAW_LISTING)
    row = catalog.ingest_missing(spark, lambda c: empty, str(tmp_path / "x"), ["Appliances"]).first()
    assert (row.status, row.raw_rows, row.kept) == ("stored", 0, 0)


def test_product_ids_are_dense_and_stable(spark):
    rows = [("same", 1)] * 250 + [(f"row {i}", i) for i in range(100)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "title string, n int")
    first = sorted(map(tuple, catalog.with_product_id(df).collect()), key=str)
    second = sorted(map(tuple, catalog.with_product_id(df.repartition(9)).collect()), key=str)
    assert first == second
    assert sorted(r[0] for r in first) == list(range(353))
    assert sum(r[1] == "same" for r in first) == 250


def test_product_ids_spread_copies_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(catalog, "COPIES_PER_CHUNK", 10)
    df = spark.createDataFrame([("same",)] * 95 + [("other",)] * 10, "title string")
    rows = catalog.with_product_id(df).collect()
    assert sorted(r.product_id for r in rows) == list(range(105))
    assert sum(r.title == "same" for r in rows) == 95


def test_catalog_reads_one_partition(spark, sf, tmp_path):
    path = str(tmp_path / "catalog")
    catalog.write_catalog(views.raw_listing(spark, sf), path)
    one = catalog.read_catalog(spark, path, "Automotive")
    assert "PartitionFilters: [isnotnull(category" in one._jdf.queryExecution().executedPlan().toString()
    assert {r.category for r in one.select("category").distinct().collect()} == {"Automotive"}


def test_ingest_resumes_and_isolates_failures(spark, sf, tmp_path):
    raw = views.raw_listing(spark, sf)
    path = str(tmp_path / "ingested")

    def load(category):
        if category == "Appliances":
            raise OSError("no such category")
        return raw.where(F.col("category") == category)

    wanted = ["Appliances", "Electronics", "Automotive"]
    first = {r.category: r for r in catalog.ingest_missing(spark, load, path, wanted).collect()}
    assert (first["Appliances"].status, first["Appliances"].error) == ("failed", "OSError: no such category")
    assert first["Electronics"].status == "stored" and first["Electronics"].kept <= first["Electronics"].raw_rows
    again = {r.category: r.status for r in catalog.ingest_missing(spark, lambda c: raw.limit(3), path, wanted).collect()}
    assert again == {"Appliances": "stored", "Electronics": "already stored", "Automotive": "already stored"}
    assert spark.read.parquet(path).where("category = 'Electronics'").count() == first["Electronics"].kept


def test_listing_plan(spark, sf, tmp_path):
    path, lite = str(tmp_path / "full"), str(tmp_path / "lite")
    publish_listings(views.raw_listing(spark, sf), path, lite, sample_size=80)
    rows = datasets.read_split(spark, path).collect()
    assert len(rows) == len({r.product_id for r in rows}) == 80
    assert len({r.title for r in rows}) == 80
    check = {r.split: r for r in datasets.verify_dataset(spark, path).collect()}
    assert check["train"]["items"] == int(80 * 0.9756) and check["train"].missing_fields == ""
    assert {r.missing_fields for r in datasets.verify_dataset(spark, path, ["title", "brand"]).collect()} == {"brand"}
    assert datasets.read_split(spark, lite).count() == 80
    moved = split_listings(views.raw_listing(spark, sf).repartition(5), sample_size=80)
    key = lambda r: (r.product_id, r.split, r.pos)
    assert sorted(map(key, moved.collect())) == sorted(map(key, rows))


def test_jobs_leave_no_stages(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "stage_root", lambda spark: str(tmp_path / "shared"))
    raw = stage(views.raw_listing(spark, sf), "raw")
    held = [os.path.dirname(raw.inputFiles()[0].removeprefix("file://"))]
    publish_listings(raw, str(tmp_path / "full"))
    folder = os.path.dirname(held[0])
    assert [os.path.join(folder, f) for f in os.listdir(folder)] == held
    assert datasets.read_split(spark, str(tmp_path / "full")).count() > 80


def test_a_session_without_a_shared_folder_is_warned_or_refused():
    def fake(master):
        context = SimpleNamespace(applicationId=f"app-{master}", master=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    with pytest.warns(UserWarning, match="checkpoint.dir"):
        session.stage_root(fake("local[2]"))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.stage_root(fake("spark://host:7077"))


def test_prompts_over_new_summaries(spark, sf, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    datasets.write_splits(views.product_split(spark, sf), source)
    publish_prompts(spark, source, target, views.summaries(spark, sf))
    rows = {r.product_id: r for r in datasets.read_split(spark, target).collect()}
    told = {r.product_id: r.summary for r in views.summaries(spark, sf).collect()}
    assert len(rows) == views.product_split(spark, sf).count()
    assert all(("Title: " in r.prompt) == (i in told) for i, r in rows.items())


def test_prompt_plan(spark, sf, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    datasets.write_splits(views.prepared(spark, sf), source)
    publish_prompts(spark, source, target)
    test = datasets.read_split(spark, target, "test")
    assert test.columns == ["product_id", "pos", "prompt", "completion", "split"]
    assert all(r.prompt.endswith("Price is $") for r in test.collect())


def test_stop_words_are_sparks(spark):
    assert stop_words() == features.english_stop_words()


def test_counting_words_moves_nothing(spark, sf):
    tokenized = features.bow_tokens(views.prepared(spark, sf))
    vocabulary = stage(features.bow_vocabulary(tokenized, 100), "vocabulary")
    for df in (features.bow_counts(tokenized, vocabulary), features.bow_matrix_stats(tokenized, vocabulary)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1
    assert "Exchange" not in features.bow_counts(tokenized, vocabulary)._jdf.queryExecution().executedPlan().toString()


def test_reading_takes_all_categories(spark, sf, tmp_path):
    raw = views.raw_listing(spark, sf).withColumn("category", F.when(F.col("product_id") < 5, "Unlisted").otherwise(F.col("category")))
    catalog.write_catalog(raw, str(tmp_path / "catalog"))
    assert catalog.read_catalogs(spark, str(tmp_path / "catalog")).count() == raw.count()


def test_vectors_equal_counts(spark, sf):
    tokenized = features.bow_tokens(views.prepared(spark, sf)).cache()
    vocabulary = features.bow_vocabulary(tokenized, 300)
    terms = features.vocabulary_terms(vocabulary)
    assert terms == sorted(terms) and len(terms) == 300
    dense = features.bow_vectors(tokenized, terms).select("product_id", vector_to_array("bow").alias("v")).collect()
    from_vectors = {(r.product_id, terms[i]): int(n) for r in dense for i, n in enumerate(r.v) if n}
    from_rows = {(r.product_id, r.term): r.occurrences for r in features.bow_counts(tokenized, vocabulary).collect()}
    assert from_vectors == from_rows
    tokenized.unpersist()


@pytest.fixture(scope="module")
def learned(spark):
    """Prices that two words decide."""
    rows = []
    for i in range(240):
        pro, cable = i % 3 == 0, i % 4 == 0
        text = f"item {'professional' if pro else 'plain'} {'cable' if cable else 'thing'} filler{i % 5}"
        rows.append((i, 100.0 + 150 * pro - 40 * cable, text, None, float(i % 7)))
    df = spark.createDataFrame(rows, "product_id bigint, price double, text string, summary string, weight double")
    df = stage(df, "learned")
    terms = features.vocabulary_terms(features.bow_vocabulary(features.bow_tokens(df)))
    return df, terms


def mae(pricer, df):
    return pricer.predict(df).agg(F.avg(F.abs(F.col("predicted") - F.col("price")))).first()[0]


def test_text_models_learn_the_words(spark, learned):
    df, terms = learned
    constant = mae(models.constant_pricer(df), df)
    linear = models.linear_bow(df, terms)
    assert mae(linear, df) < 1e-3 * constant
    words = {r.feature: r for r in models.top_words(linear, spark, 2).collect()}
    assert words["professional"].effect == "increases" and words["cable"].effect == "decreases"
    forest = models.random_forest(df, terms, rows=200, trees=10, depth=4)
    boosted = models.boosted_trees(df, terms, rounds=15, depth=3)
    assert mae(forest, df) < 0.5 * constant and mae(boosted, df) < 0.5 * constant
    top = models.feature_importance(boosted, spark, 3).collect()
    assert {"professional", "plain"} & {r.word for r in top} and [r["rank"] for r in top] == [1, 2, 3]


def test_linear_models_equal_least_squares(spark, learned):
    import numpy

    df, terms = learned
    rows = df.orderBy("product_id").collect()
    y = numpy.array([r.price + 3 * (r.product_id % 11) for r in rows])
    noisy = df.withColumn("price", F.col("price") + 3 * (F.col("product_id") % 11))

    def solve(features):
        x = numpy.column_stack([numpy.ones(len(rows)), features])
        return numpy.maximum(0, x @ numpy.linalg.lstsq(x, y, rcond=None)[0])

    def predicted(pricer):
        return [r.predicted for r in pricer.predict(noisy).orderBy("product_id").collect()]

    counts = [[r.text.split().count(t) for t in terms] for r in rows]
    assert predicted(models.linear_bow(noisy, terms)) == pytest.approx(solve(counts), abs=0.05)
    numeric = [[r.weight, float(r.weight == 0), len(r.text)] for r in rows]
    assert predicted(models.linear_numeric(noisy)) == pytest.approx(solve(numeric), abs=1e-6)


def test_boosting_goes_on_and_repeats(spark, learned):
    """Each round lowers the error, to what a plain version reaches; held-out rows end the fit; no partitioning changes it."""
    df, terms = learned
    fits = [models.boosted_trees(given, terms, rounds=20, rate=0.3, depth=2, penalty=0.0) for given in (df, df.repartition(7))]
    errors = [e for e, _ in fits[0].model.errors]
    assert fits[0].model.rounds == 20 and all(b < a or b < 0.1 for a, b in zip(errors, errors[1:])) and errors[-1] < 0.01 * errors[0]
    assert [[t.feature.tolist(), t.bin.tolist(), t.value.tolist()] for t in fits[0].model.trees] == [
        [t.feature.tolist(), t.bin.tolist(), t.value.tolist()] for t in fits[1].model.trees]
    # The first split is the best of all, and its leaves the means of their rows.
    rows = [(set(r.text.split()), r.price) for r in df.collect()]
    mean = sum(p for _, p in rows) / len(rows)

    def drop(term):
        sides = [[p - mean for words, p in rows if (term in words) == side] for side in (False, True)]
        return sum(sum(s) ** 2 / len(s) for s in sides if s)

    first = fits[0].model.trees[0]
    assert drop(terms[first.feature[0]]) == pytest.approx(max(map(drop, terms)))
    noise = df.withColumn("price", (F.xxhash64("product_id") % 100 + 200).cast("double"))
    stopped = models.boosted_trees(noise.where("product_id % 2 = 0"), terms, rounds=50, validation=noise.where("product_id % 2 = 1"), patience=3).model
    assert stopped.rounds < 47 and stopped.errors[-1][1] == min(e for _, e in stopped.errors)


def test_boosting_bins_and_empty_texts(spark):
    """Counts beyond the bins, rows without a term, and a word in every row."""
    rows = [(i, 10.0 * (i % 9), "every " + "many " * (i % 9), None, 0.0) for i in range(90)] + [(99, 5.0, "", None, 0.0)]
    df = spark.createDataFrame(rows, "product_id bigint, price double, text string, summary string, weight double")
    fit = models.boosted_trees(df, ["absent", "every", "many"], rounds=40, rate=0.5, depth=3)
    assert mae(fit, df) < 1.0 and fit.model.featureImportances[2] > 0.9 and fit.model.featureImportances[0] == 0


def test_least_squares_of_any_rank(spark, learned):
    """Words that always stand together share one effect, and a word in every row has none."""
    df, terms = learned
    doubled = df.withColumn("text", F.concat("text", F.lit(" twin"), F.when(F.col("text").contains("cable"), F.lit(" cablecopy")).otherwise("")))
    fit = models.linear_bow(doubled, [*terms, "cablecopy", "twin"])
    effect = dict(zip(fit.terms, fit.model.coefficients))
    assert effect["cable"] == pytest.approx(effect["cablecopy"]) and effect["twin"] == 0.0
    assert fit.model.rank < len(fit.terms) and mae(fit, doubled) < 1e-6


def test_forest_repeats_at_any_partitioning(spark, learned):
    df, terms = learned
    predictions = [
        {r.product_id: r.predicted for r in models.random_forest(given, terms, rows=150, trees=5, depth=5).predict(df).collect()}
        for given in (df, df.repartition(6))
    ]
    assert predictions[0] == predictions[1]


def test_predictions_never_fall_below_zero(spark):
    rows = [(i, float(max(0, 20 - i)), "x" * (i + 1), None, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "product_id bigint, price double, text string, summary string, weight double")
    predicted = [r.predicted for r in models.linear_numeric(df).predict(df).collect()]
    assert min(predicted) == 0.0 and max(predicted) > 0.0
    assert set(df.columns) < set(models.linear_numeric(df).predict(df).columns)


def test_ranking_of_pricers(spark, learned):
    df, terms = learned
    results = {r.model_name: r.mae for r in rank_pricers(
        [models.random_pricer(), models.constant_pricer(df), models.linear_bow(df, terms)], df).collect()}
    assert results["seeded guess"] > results["mean price"] > results["least squares on words"]


def test_all_test_items_are_judged(spark):
    """Also beyond 200 of them; a sample is drawn if one is asked for, and items without an id or listed twice count as they come."""
    rows = [(i if i else None, 100.0) for i in range(250)] + [(7, 100.0), (8, 600.0)]
    test = spark.createDataFrame(rows, "product_id bigint, price double")
    pricer = models.Pricer("fixed", lambda df: df.withColumn("predicted", F.lit(100.0)))
    (whole,) = rank_pricers([pricer], test).collect()
    assert whole.sample_size == 252 and whole.mae == pytest.approx(500 / 252)
    (some,) = rank_pricers([pricer], test, sample_size=50).collect()
    assert some.sample_size == 50


def test_batch_predict_isolates_rows(spark):
    def load():
        def predict(frame):
            if (frame["x"] < 0).any():
                raise ValueError
            return frame["x"] * 2

        return predict

    df = spark.createDataFrame([(i, float(i if i % 5 else -1)) for i in range(50)], "id bigint, x double")
    wide = df.withColumn("text", F.lit("long"))
    scored = models.batch_predict(wide, "double", load, ["x"])
    assert scored.columns == ["id", "x", "text", "predicted", "predicted_failed"]
    assert {r.id: (r.predicted, r.predicted_failed) for r in scored.collect()} == {i: (i * 2.0 if i % 5 else 0.0, i % 5 == 0) for i in range(50)}
    # Only the inputs cross to Python.
    assert "struct(x, x" in scored._jdf.queryExecution().optimizedPlan().toString()


def test_batch_predict_raises_what_is_no_failure_of_a_row(spark):
    def load():
        def predict(frame):
            return frame["missing"]

        return predict

    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "id bigint, x double").coalesce(1)
    with pytest.raises(Exception, match="missing"):
        models.batch_predict(df, "broken", load, ["x"]).collect()


def test_stream_equals_batch_and_resumes(spark, sf, tmp_path):
    deals = views.deal(spark, sf)
    source, sink, checkpoint = (str(tmp_path / n) for n in ("arriving", "scored", "checkpoint"))
    deals.where("deal_id % 2 = 0").repartition(3).write.parquet(source)
    stream_deals(read_deals(spark, source, 1), sink, checkpoint).awaitTermination()
    deals.where("deal_id % 2 = 1").repartition(2).write.mode("append").parquet(source)
    stream_deals(read_deals(spark, source, 1), sink, checkpoint).awaitTermination()
    batch = dealing.score_deals(deals)
    columns = ["deal_id", "estimate", "discount", "status"]
    scored = read_scored(spark, sink)
    assert sorted(map(tuple, scored.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    assert read_scored(spark, sink, "alert").count() == dealing.deal_alerts(deals).count()
    assert dealing.alert_summary(scored).first() == dealing.alert_summary(batch).first()


def test_ingests_leave_what_one_would(spark):
    rows = [(i, f"title {i % 40}" if i % 50 else None, f"text {i % 23}" if i % 9 else None, None) for i in range(400)]
    schema = "product_id bigint, title string, text string, summary string"
    whole = spark.createDataFrame(rows, schema)
    want = {r.product_id for r in dedup.dedup_title_then_text(whole).collect()}
    name = None
    for part in (rows[:100], [], rows[50:300], rows[300:]):
        name = ingest_dedup.ingest(spark, name, spark.createDataFrame(part, schema))
    assert {r.product_id for r in ingest_dedup.ingested_survivors(ingest_dedup.read_index(spark, name)).collect()} == want
    # The stored index is joined where it lies: one exchange, that of the new keys.
    merged = ingest_dedup.merged_winners(ingest_dedup.read_index(spark, name), whole)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def asof_brute(left, right, within=None):
    out = []
    for i, key, at in left:
        older = [(t, v) for k, t, v in right if k == key and k is not None and t is not None and at is not None and t <= at]
        best = max(older, default=(None, None))
        out.append((i, best[1] if within is None or best[0] is None or (at - best[0]).total_seconds() <= within else None))
    return out


@pytest.mark.parametrize("bucket, within", [(86_400, None), (60, None), (7, 3600), (10**9, 60)])
def test_asof_join(spark, bucket, within):
    """One key with half of all rows, ties, null keys and times, and rows before any answer, in buckets of any width."""
    import datetime
    import random

    draw, start = random.Random(4), datetime.datetime(2024, 1, 1)

    def moment():
        return None if draw.random() < 0.03 else start + datetime.timedelta(seconds=draw.randrange(20_000))

    def key():
        return "hot" if draw.random() < 0.5 else draw.choice(["a", "b", None])

    left = [(i, key(), moment()) for i in range(300)]
    right = [(key(), moment(), v) for v in range(200)]
    right += [(k, t, v + 500) for k, t, v in right[:40]]
    deals = spark.createDataFrame(left, "id int, url string, ts timestamp")
    answers = spark.createDataFrame(right, "url string, ts timestamp, value int")
    got = asof_join(deals, answers, ["url"], "ts", ["value"], within=within, bucket_seconds=bucket)
    assert got.columns == ["id", "url", "ts", "value"]
    assert sorted((r.id, r.value) for r in got.collect()) == sorted(asof_brute(left, right, within), key=lambda x: x[0])
    assert asof_join(deals.limit(0), answers, ["url"], "ts", ["value"]).count() == 0
    assert {r.value for r in asof_join(deals, answers.limit(0), ["url"], "ts", ["value"]).collect()} == {None}


def test_alerts_of_a_page_are_not_repeated(spark, tmp_path):
    """Repeats in one batch and over batches, a late deal, one too late, and a page heard of again after the wait."""
    import datetime

    start = datetime.datetime(2024, 1, 1)

    def deals(*rows):
        full = [(i, start + datetime.timedelta(minutes=m), "t", "d", price, url, 100.0, 100.0) for i, m, price, url in rows]
        return spark.createDataFrame(full, DEAL)

    batches = [
        deals((1, 0, 10.0, "a"), (2, 30, 10.0, "a"), (3, 5, 90.0, "b"), (4, 20, 10.0, "b"), (5, 1, 10.0, None)),
        deals((6, 90, 10.0, "a"), (7, 25, 10.0, "b"), (8, 100, 10.0, "c"), (9, 99, 10.0, "c")),
        deals((10, 121, 10.0, "a"), (11, 300, 10.0, "b"), (12, 1, 10.0, "d")),
    ]
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    for batch in batches:
        batch.write.mode("append").parquet(source)
        stream_first_alerts(read_deals(spark, source), out, checkpoint, 2 * 3600, late="1 hour").awaitTermination()
    # 12 comes more than an hour behind 100 minutes; 3 is no alert.
    assert sorted(r.deal_id for r in spark.read.parquet(out).collect()) == [1, 4, 9, 10, 11]


def test_grouped_report_adds_up(spark, sf):

    raw = views.raw_listing(spark, sf)
    rows = cleaning.grouped_report(raw, views.product_split(spark, sf)).collect()
    by_category = {r.category: r.items for r in rows if r.grouping == 3}
    assert by_category == {r.category: r.raw_rows for r in cleaning.cleaning_report(raw).collect()}
    assert {r.category: r.items for r in rows if r.grouping == 2 and r.reason is None} == {
        r.category: r.kept for r in cleaning.cleaning_report(raw).collect() if r.kept}
    assert {r.split: r.items for r in rows if r.grouping == 5 and r.split} == {r.split: r["items"] for r in splitting.split_report(views.product_split(spark, sf)).collect()}
    assert [r["items"] for r in rows if r.grouping == 7] == [sum(by_category.values())]


def test_range_join(spark):
    """Ranges of a point and of the whole line, ties at the ends, nulls, NaN, and as many points at one price as elsewhere."""
    import random

    draw = random.Random(9)
    points = [(i, 42.0 if i % 2 else draw.choice([None, float("nan"), -3.5, draw.uniform(-50, 900)])) for i in range(200)]
    ranges = [(j, low, low + draw.choice([0.0, 1.0, 7.0, 300.0, 5000.0])) for j in range(120) for low in [float(draw.randrange(-60, 900))]]
    ranges += [(500, 42.0, 42.0), (501, None, 5.0), (502, 9.0, 1.0), (503, -1e9, 1e9), (504, 0.0, float("nan"))]
    left, right = spark.createDataFrame(points, "id int, price double"), spark.createDataFrame(ranges, "band int, low double, high double")
    want = sorted((i, j) for i, p in points for j, a, b in ranges if None not in (p, a, b) and p == p and b == b and a <= p <= b)
    for width in (1.0, 64.0, 1e6):
        met = range_join(left, right, "price", "low", "high", width)
        assert sorted((r.id, r.band) for r in met.collect()) == want
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert range_join(left, right.limit(0), "price", "low", "high", 1.0).count() == 0


def test_alerts_over_time(spark, tmp_path):
    """Windows and sessions of a stream equal those of the batch, but for what is not over yet; a late deal still counts."""
    import datetime

    start = datetime.datetime(2024, 1, 1)
    minutes = [0, 10, 70, 65, 200, 195, 420, 425, 900, 3000, 3001]
    rows = [(i, start + datetime.timedelta(minutes=m), "t", "d", 10.0 if i % 3 else 95.0, f"u{i % 2}", 100.0, 100.0) for i, m in enumerate(minutes)]
    batch = dealing.score_deals(spark.createDataFrame(rows, DEAL))
    source = str(tmp_path / "in")
    for part in (rows[:4], rows[4:7], rows[7:]):
        spark.createDataFrame(part, DEAL).write.mode("append").parquet(source)
        for name, window in (("windows", "1 hour"), ("sessions", None)):
            stream_alert_counts(read_deals(spark, source), str(tmp_path / name), str(tmp_path / f"{name}-check"), window, gap="2 hours").awaitTermination()
    last = start + datetime.timedelta(minutes=3001 - 60)
    for name, whole in (("windows", dealing.alerts_per_window(batch)), ("sessions", dealing.alert_sessions(batch, "2 hours"))):
        got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / name)).select(*whole.columns).collect())
        assert got == sorted(tuple(r) for r in whole.where(F.col("end") <= F.lit(last)).collect()) and len(got) > 3
