"""Parsing answers, errors, leaderboards."""

from pyspark.sql import functions as F

from pricewright.functions.numbers import completion_to_price, parse_output
from pricewright.operators import evaluation

from . import views
from .registry import query

MODELS = ("model_a", "model_b", "model_c")
_BARE = "replace(replace(output, '$', ''), ',', '')"
_UNSIGNED = rf"coalesce(try_cast(nullif(regexp_extract({_BARE}, '\d+\.?\d*'), '') as double), 0.0)"


def _results(spark, sf_dir):
    items = views.table(spark, sf_dir, "events").select(F.col("event_id").alias("item_id"))
    return evaluation.evaluate_models(views.model_output(spark, sf_dir), items)


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


@query("e1_parse_output", f"""
    select item_id, model_name, predicted as signed, {_UNSIGNED} as notebook,
      case when {_UNSIGNED} < 10000 then {_UNSIGNED} else 0.0 end as bounded, {_UNSIGNED} as raw from scored""", "scored")
def parse_outputs(spark, sf_dir):
    return views.model_output(spark, sf_dir).select(
        "item_id", "model_name", *[parse_output(F.col("output"), m).alias(m) for m in ("signed", "notebook", "bounded", "raw")])


@query("e2_score", "select item_id, model_name, predicted, abs_error from scored", "scored")
def score(spark, sf_dir):
    return evaluation.score(views.model_output(spark, sf_dir)).select("item_id", "model_name", "predicted", "abs_error")


@query("e3_evaluate_models", "select model_name, round(mae, 6) as mae, sample_size from results", "results")
def evaluate_models(spark, sf_dir):
    return _rounded(_results(spark, sf_dir), "mae")


@query("e3_evaluate_arrays", """
    select model_name, round(avg(abs_error), 6) as mae, count(*) as sample_size,
      array_to_string(list(abs_error::decimal(18,4) order by item_id), ' ') as errors
    from sampled group by model_name""", "sampled")
def evaluate_arrays(spark, sf_dir):
    """The scored rows of the 200 sampled items, as one list per model."""
    scored = evaluation.score(evaluation.sampled_outputs(views.model_output(spark, sf_dir)))
    rows = F.array_sort(F.collect_list(F.struct("item_id", "abs_error")))
    results = scored.groupBy("model_name").agg(F.avg("abs_error").alias("mae"), F.count("*").alias("sample_size"), rows.alias("_rows"))
    errors = F.array_join(F.transform("_rows", lambda r: r["abs_error"].cast("decimal(18,4)").cast("string")), " ")
    return _rounded(results.select("model_name", "mae", "sample_size", errors.alias("errors")), "mae")


@query("e4_leaderboard", """
    select row_number() over (order by mae desc, model_name) as position, model_name, round(mae, 6) as mae,
      round(max(mae) over () - mae, 6) as gain from results""", "results")
def leaderboard(spark, sf_dir):
    return _rounded(evaluation.leaderboard(_results(spark, sf_dir)), "mae", "gain")


@query("e4_leaderboard_summary", """
    select best_model, round(best_mae, 6) as best_mae, round(worst_mae, 6) as worst_mae, round(worst_mae - best_mae, 6) as gain,
      round(100.0::double * (worst_mae - best_mae) / worst_mae, 6) as gain_pct
    from (select first(model_name order by mae, model_name) as best_model, min(mae) as best_mae, max(mae) as worst_mae from results)""",
    "results")
def leaderboard_summary(spark, sf_dir):
    return _rounded(evaluation.leaderboard_summary(_results(spark, sf_dir)), "best_mae", "worst_mae", "gain", "gain_pct")


@query("e5_compare_to_baseline", """
    select model_name, round(mae, 6) as mae, 68.23::double as baseline_mae, round(68.23::double - mae, 6) as gain,
      round(100.0::double * (68.23::double - mae) / 68.23::double, 6) as gain_pct from results""", "results")
def compare_to_number(spark, sf_dir):
    return _rounded(evaluation.compare_to_baseline(_results(spark, sf_dir), 68.23), "mae", "gain", "gain_pct")


@query("e5_compare_to_model", """
    select model_name, round(mae, 6) as mae, round(b, 6) as baseline_mae, round(b - mae, 6) as gain,
      round(100.0::double * (b - mae) / b, 6) as gain_pct
    from results, (select mae as b from results where model_name = 'model_a')""", "results")
def compare_to_model(spark, sf_dir):
    compared = evaluation.compare_to_baseline(_results(spark, sf_dir), "model_a")
    return _rounded(compared, "mae", "baseline_mae", "gain", "gain_pct")


@query("e6_item_status", f"""
    select item_id, model_name, actual, {_UNSIGNED} as predicted, abs({_UNSIGNED} - actual) as abs_error,
      case when abs({_UNSIGNED} - actual) < 50 then 'ok' else 'warn' end as status
    from model_output where item_id in (select event_id from events order by {views.uniform_bits('event_id')}, event_id limit 5)""",
    "model_output")
def item_status(spark, sf_dir):
    return evaluation.item_status(views.model_output(spark, sf_dir))


@query("e7_side_by_side", """
    select item_id, max(actual) as actual, max(predicted) filter (model_name = 'model_a') as model_a,
      max(predicted) filter (model_name = 'model_b') as model_b, max(predicted) filter (model_name = 'model_c') as model_c
    from scored group by item_id""", "scored")
def side_by_side(spark, sf_dir):
    return evaluation.side_by_side(evaluation.score(views.model_output(spark, sf_dir)), MODELS)


@query("e8_completion_to_price", "select product_id, completion::double as actual from prompt", "prompt")
def completion_price(spark, sf_dir):
    return views.prompts(spark, sf_dir).select("product_id", completion_to_price(F.col("completion")).alias("actual"))
