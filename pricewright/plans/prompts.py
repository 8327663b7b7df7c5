"""A split dataset to prompt pairs: one narrow pass, unless summaries are joined."""

from pyspark.sql import DataFrame, SparkSession

from ..functions.tokens import DEFAULT_TOKENS
from ..operators.prompting import attach_summaries, build_prompts
from ..sources.datasets import read_split, write_prompts


def prompts_from(splits: DataFrame, summaries: DataFrame | None = None, tokens=DEFAULT_TOKENS) -> DataFrame:
    """Prompts over the given summaries, or over the stored summary and text."""
    if summaries is not None:
        splits = attach_summaries(splits, summaries)
    return build_prompts(splits, tokens=tokens)


def publish_prompts(
    spark: SparkSession, source: str, target: str, summaries: DataFrame | None = None, tokens=DEFAULT_TOKENS
) -> None:
    """Write the prompts of a stored dataset, over ``summaries`` where they are given."""
    write_prompts(prompts_from(read_split(spark, source), summaries, tokens), target)
