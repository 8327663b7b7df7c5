"""Mean absolute error on one shared sample, and the tables built on it.

Outputs come as a long table (item_id, model_name, output, actual).
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from ..constants import EVALUATION_SIZE, GOOD_ERROR, QUICK_TEST_ROWS, SEED
from ..functions.numbers import absolute_error, parse_number_output, parse_output, price_interval
from ..session import stage
from .cleaning import percent
from .ranking import head_subset, uniform_sample


def score(outputs: DataFrame, mode: str = "signed") -> DataFrame:
    """Add ``predicted`` and ``abs_error``; outputs may be text or numbers."""
    parse = parse_output if isinstance(outputs.schema["output"].dataType, StringType) else parse_number_output
    return outputs.withColumn("predicted", parse(F.col("output"), mode)).withColumn(
        "abs_error", absolute_error(F.col("predicted"), F.col("actual"))
    )


def _of_items(outputs: DataFrame, items: DataFrame) -> DataFrame:
    return outputs.join(items.select("item_id"), "item_id", "left_semi")


def sampled_outputs(
    outputs: DataFrame, items: DataFrame | None = None, sample_size: int = EVALUATION_SIZE, seed: int = SEED
) -> DataFrame:
    """The outputs of the min(sample_size, n) items that every model is judged on."""
    # The draw reads its pool three times.
    pool = stage(outputs.select("item_id").distinct(), "evaluation-pool") if items is None else items.select("item_id")
    return _of_items(outputs, uniform_sample(pool, sample_size, "item_id", seed))


def mean_errors(outputs: DataFrame, mode: str = "signed") -> DataFrame:
    """MAE and rows per model over all given outputs."""
    return score(outputs, mode).groupBy("model_name").agg(
        F.avg("abs_error").alias("mae"), F.count("*").alias("sample_size")
    )


def evaluate_models(
    outputs: DataFrame, items: DataFrame | None = None, sample_size: int = EVALUATION_SIZE, seed: int = SEED,
    mode: str = "signed",
) -> DataFrame:
    """MAE per model on the same min(sample_size, n) items.

    ``items`` holds the ids to draw from; by default all ids of the outputs.
    The errors themselves are the rows of ``score(sampled_outputs(...))``.
    """
    return mean_errors(sampled_outputs(outputs, items, sample_size, seed), mode)


def with_interval(predictions: DataFrame, results: DataFrame) -> DataFrame:
    """Add ``low`` and ``high``: the prediction less and plus the MAE of its model.

    The results, one row per model, enter as a map: the predictions stay where
    they are, however many share a model.
    """
    by_model = results.agg(F.map_from_entries(F.collect_list(F.struct("model_name", "mae")))).scalar()
    low, high = price_interval(F.col("predicted"), F.try_element_at(by_model, F.col("model_name")))
    return predictions.withColumns({"low": low, "high": high})


def leaderboard(results: DataFrame) -> DataFrame:
    """Worst model first, with the gain of each over the worst."""
    # Windows over one row per model.
    everything = Window.partitionBy()
    order = everything.orderBy(F.desc("mae"), "model_name")
    return results.select(
        F.row_number().over(order).cast("bigint").alias("position"), "model_name", "mae",
        (F.max("mae").over(everything) - F.col("mae")).alias("gain"),
    ).orderBy("position")


def leaderboard_summary(results: DataFrame) -> DataFrame:
    """The best model and its gain over the worst."""
    return results.agg(
        F.min_by("model_name", F.struct(F.col("mae"), F.col("model_name"))).alias("best_model"),
        F.min("mae").alias("best_mae"),
        F.max("mae").alias("worst_mae"),
    ).withColumn("gain", F.col("worst_mae") - F.col("best_mae")).withColumn(
        "gain_pct", percent(F.col("gain"), F.col("worst_mae"))
    )


def compare_to_baseline(results: DataFrame, baseline: float | str) -> DataFrame:
    """Gain of each model over a fixed MAE or over a named model."""
    if isinstance(baseline, str):
        reference = results.where(F.col("model_name") == baseline).agg(F.max("mae")).scalar()
    else:
        reference = F.lit(float(baseline))
    compared = results.select("model_name", "mae", reference.alias("baseline_mae"))
    gain = F.col("baseline_mae") - F.col("mae")
    return compared.withColumn("gain", gain).withColumn("gain_pct", percent(gain, F.col("baseline_mae")))


def item_status(
    outputs: DataFrame, count: int = QUICK_TEST_ROWS, limit: float = GOOD_ERROR, seed: int = SEED, mode: str = "raw"
) -> DataFrame:
    """Each model on the first items in shuffled order, with a verdict."""
    first = head_subset(outputs.select("item_id").distinct(), count, "item_id", seed)
    scored = score(_of_items(outputs, first), mode)
    return scored.select(
        "item_id", "model_name", "actual", "predicted", "abs_error",
        F.when(F.col("abs_error") < limit, "ok").otherwise("warn").alias("status"),
    )


def side_by_side(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per item and one column per model, in a single aggregate.

    A pivot would aggregate, and shuffle, per item and model first.
    """
    columns = [F.max(F.when(F.col("model_name") == m, F.col("predicted"))).alias(m) for m in models]
    return predictions.groupBy("item_id").agg(F.max("actual").alias("actual"), *columns)
