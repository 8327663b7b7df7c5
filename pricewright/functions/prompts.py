"""Product summaries and price prompts."""

from pyspark.sql import Column, functions as F

from ..constants import PRICE_PREFIX, QUESTION
from .numbers import completion
from .text import strip_whitespace

SUMMARY_LABELS = ("Title", "Category", "Brand", "Description", "Details")


def format_summary(title: Column, category: Column, brand: Column, description: Column, features: Column) -> Column:
    """One labelled line per part; empty parts leave no line."""
    parts = (title, category, brand, description, features)
    return F.concat_ws("\n", *[
        F.when(part != "", F.concat(F.lit(f"{label}: "), part)) for label, part in zip(SUMMARY_LABELS, parts)
    ])


def summary_title(summary: Column, width: int = 28) -> Column:
    """First line without its label, cut to a column width."""
    return F.substring(F.replace(F.substring_index(summary, "\n", 1), F.lit("Title: "), F.lit("")), 1, width)


def parse_summary(summary: Column) -> Column:
    """Read the labelled fields back into a struct; null where a field is absent.

    A field goes on over line ends until a line with another label, or the end.
    """
    labels = "|".join(SUMMARY_LABELS)
    return F.struct(*[
        F.nullif(
            F.regexp_extract(summary, rf"(?s)(?:^|\n){label}: (.*?)(?:\n(?:{labels}): |\z)", 1), F.lit("")
        ).alias(label.lower())
        for label in SUMMARY_LABELS
    ])


def inference_prompt(summary: Column) -> Column:
    """Question, blank line, summary, blank line, ``Price is $``."""
    return F.concat(F.lit(f"{QUESTION}\n\n"), strip_whitespace(summary), F.lit(f"\n\n{PRICE_PREFIX}"))


def training_prompt(summary: Column, price: Column) -> Column:
    """The inference prompt with its answer, the price to the nearest dollar."""
    return F.concat(inference_prompt(summary), completion(price))


def mask_answer(prompt: Column, placeholder: str = "[answer hidden]") -> Column:
    """Cut at the first ``Price is $`` and put a placeholder for the answer."""
    return F.concat(F.substring_index(prompt, PRICE_PREFIX, 1), F.lit(f"{PRICE_PREFIX}{placeholder}"))
