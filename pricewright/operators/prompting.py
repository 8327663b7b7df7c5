"""Prompt pairs under a token budget, and length reports."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..constants import (
    HIGH_TRUNCATION_PERCENT, MAX_SEQUENCE_LENGTH, PROMPT_OVERHEAD, SEQUENCE_CUTOFFS, SUMMARY_TOKEN_BUDGET,
)
from ..functions.numbers import completion
from ..functions.prompts import inference_prompt, training_prompt
from ..functions.text import collapse_whitespace, effective_text
from ..functions.tokens import DEFAULT_TOKENS
from .barrier import with_once
from .cleaning import percent


def attach_summaries(products: DataFrame, summaries: DataFrame) -> DataFrame:
    """Rewritten summaries by product id; the raw text is dropped to null."""
    rest = products.drop("summary").withColumn("text", F.lit(None).cast("string"))
    return rest.join(summaries.select("product_id", "summary"), "product_id", "left")


def with_tokens(products: DataFrame, tokens=DEFAULT_TOKENS) -> DataFrame:
    """Add ``body`` (summary or text) and ``n_tokens``."""
    return _with_encoded(products, tokens).drop("_encoded")


def _with_encoded(products: DataFrame, tokens) -> DataFrame:
    # Stacked, so that the text is encoded once for counting and cutting.
    return (
        products.withColumn("body", effective_text(F.col("summary"), F.col("text")))
        .withColumn("_encoded", tokens.encode(F.col("body")))
        .withColumn("n_tokens", tokens.count(F.col("_encoded")))
    )


def build_prompts(
    splits: DataFrame, budget: int = SUMMARY_TOKEN_BUDGET, tokens=DEFAULT_TOKENS
) -> DataFrame:
    """One narrow pass over all splits: answers in train and val, none in test."""
    encoded = _with_encoded(splits, tokens)
    over = F.col("n_tokens") > budget
    cut = F.when(over, tokens.head(F.col("_encoded"), budget)).otherwise(F.col("body"))
    prompted = encoded.withColumn("truncated", over).withColumn("_cut", cut)
    prompt = F.when(F.col("split") == "test", inference_prompt(F.col("_cut"))).otherwise(
        training_prompt(F.col("_cut"), F.col("price"))
    )
    return prompted.select(
        "product_id", "split", "pos", prompt.alias("prompt"),
        completion(F.col("price")).alias("completion"), "truncated",
    )


def truncation_report(prompts: DataFrame) -> DataFrame:
    counts = prompts.groupBy("split").agg(
        F.count("*").alias("items"), F.count_if("truncated").alias("truncated")
    )
    share = F.coalesce(percent(F.col("truncated"), F.col("items")), F.lit(0.0))
    return counts.withColumn("truncated_pct", share).withColumn("high", share > HIGH_TRUNCATION_PERCENT)


def _train(splits: DataFrame) -> DataFrame:
    return splits.where(F.col("split") == "train")


def token_profile(splits: DataFrame, tokens=DEFAULT_TOKENS) -> DataFrame:
    """Mean, median, 95th percentile (interpolated) and maximum over the train rows.

    Percentiles are exact and hold one entry per distinct count.
    """
    return with_tokens(_train(splits), tokens).agg(
        F.count("*").alias("items"),
        F.avg("n_tokens").alias("mean_tokens"),
        F.median("n_tokens").alias("median_tokens"),
        F.percentile("n_tokens", 0.95).alias("p95_tokens"),
        F.max("n_tokens").alias("max_tokens"),
    )


def cutoff_sweep(
    splits: DataFrame, cutoffs: Sequence[int] = SEQUENCE_CUTOFFS,
    chosen: int = MAX_SEQUENCE_LENGTH, overhead: int = PROMPT_OVERHEAD, tokens=DEFAULT_TOKENS,
) -> DataFrame:
    """Share of rows each sequence length would truncate, from one aggregate."""
    shares = with_tokens(_train(splits), tokens).agg(*[
        (F.avg((F.col("n_tokens") > cutoff - overhead).cast("double")) * 100.0).alias(str(cutoff))
        for cutoff in cutoffs
    ])
    entries = F.array(*[
        F.struct(F.lit(cutoff).alias("cutoff"), F.col(str(cutoff)).alias("truncated_pct"),
                 F.lit(cutoff == chosen).alias("chosen"))
        for cutoff in cutoffs
    ])
    return shares.select(F.inline(entries))


def prompt_word_stats(prompts: DataFrame) -> DataFrame:
    """Whitespace words per prompt over the train rows.

    Words are counted once; all figures come from the rows per count, of which
    there are no more than words in the longest prompt.
    """
    flat = with_once(_train(prompts).select("prompt"), _flat=collapse_whitespace(F.col("prompt")))
    n_words = F.when(F.col("_flat") == "", 0).otherwise(F.size(F.split("_flat", " ")))
    table = flat.groupBy(n_words.alias("n_words")).agg(F.count("*").alias("rows"))
    entries = F.array_sort(F.collect_list(F.struct("n_words", "rows")))
    stats = table.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("items"),
        (F.sum(F.col("n_words") * F.col("rows")) / F.sum("rows")).alias("mean_words"),
        F.max("n_words").cast("bigint").alias("max_words"), entries.alias("_entries"),
    )
    # The element at items // 2 of the sorted counts: the first whose running total passes it.
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("median"))
    walked = F.aggregate("_entries", start, lambda acc, e: F.struct(
        (acc["seen"] + e["rows"]).alias("seen"),
        F.coalesce(acc["median"], F.when(acc["seen"] + e["rows"] > F.floor(F.col("items") / 2), e["n_words"])).alias("median"),
    ))
    return stats.select("items", "mean_words", "max_words", walked["median"].cast("bigint").alias("median_words"))


def prompt_sample(prompts: DataFrame) -> DataFrame:
    """The first train prompt and the first test prompt."""
    return prompts.where((F.col("pos") == 0) & F.col("split").isin("train", "test")).select(
        "split", "prompt", "completion"
    )
