"""Train, predict, and rank by mean absolute error on the same test items."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..constants import SEED
from ..operators.evaluation import mean_errors
from ..operators.models import Pricer
from ..operators.ranking import uniform_sample
from ..session import stage


def model_outputs(pricers: Sequence[Pricer], items: DataFrame) -> DataFrame:
    """The long table of predictions of every pricer on the same items."""
    return reduce(DataFrame.unionByName, [
        pricer.predict(items).select(
            F.col("product_id").alias("item_id"), F.lit(pricer.name).alias("model_name"),
            F.col("predicted").alias("output"), F.col("price").alias("actual"),
        )
        for pricer in pricers
    ])


def rank_pricers(
    pricers: Sequence[Pricer], test: DataFrame, sample_size: int | None = None, seed: int = SEED
) -> DataFrame:
    """MAE per pricer on all test items, or on one sample of ``sample_size``; what is scored is stored once."""
    items = test if sample_size is None else uniform_sample(test, sample_size, seed=seed)
    return mean_errors(model_outputs(pricers, stage(items, "evaluation-items")))
