"""Raw listings to products, and reports on what was rejected.

The steps of the text are stacked projections so that each regex result,
named several times by the next step, is computed once. The length filter
comes after a barrier, or it would evaluate the whole chain a second time.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from ..constants import MAX_PRICE, MIN_PRICE, MIN_TEXT_LENGTH
from ..functions.details import details_pair, last_value, object_of, serialize_details
from ..functions.numbers import parse_price, price_in_range, weight_pounds
from ..functions.text import (
    collapse_whitespace, drop_part_numbers, last_part_number_start, word_end,
)
from .barrier import with_once

BAD_PRICE = "unparseable_price"
OUT_OF_RANGE = "price_out_of_range"
SHORT_TEXT = "text_too_short"


def joined_list(df: DataFrame, name: str, separator: str = " ") -> Column:
    """A list column as one text; a plain string column as it is."""
    if isinstance(df.schema[name].dataType, ArrayType):
        return F.coalesce(F.array_join(name, separator), F.lit(""))
    return F.coalesce(F.col(name), F.lit(""))


def with_clean_text(
    df: DataFrame, combined: Column, when: Column | None = None, name: str = "text", max_length: int | None = None
) -> DataFrame:
    """Collapse whitespace, delete part numbers, cut to ``max_length`` if given.

    Where ``when`` is not true the text is null and nothing is evaluated.
    """
    wanted = F.lit(True) if when is None else when
    start, end = F.col("_start"), F.col("_end")
    flat = F.col("_flat")
    text = drop_part_numbers(flat, end)
    return (
        df.withColumn("_flat", F.when(wanted, collapse_whitespace(combined)))
        .withColumn("_start", last_part_number_start(flat))
        .withColumn("_end", F.when(start == 0, 0).otherwise(word_end(flat, start)))
        .withColumn(name, text if max_length is None else F.substring(text, 1, max_length))
        .drop("_flat", "_start", "_end")
    )


def build_text(
    raw: DataFrame, when: Column | None = None, name: str = "text", max_length: int | None = None,
    entries: str | None = None,
) -> DataFrame:
    """Add the text of title, description, features and serialized details.

    ``entries`` names a column that holds the details as read by ``details_object``.
    """
    combined = F.concat_ws(
        "\n",
        F.coalesce(F.col("title"), F.lit("")),
        joined_list(raw, "description"),
        joined_list(raw, "features"),
        serialize_details(F.coalesce(F.col("details"), F.lit("")), F.col(entries) if entries else None),
    )
    return with_clean_text(raw, combined, when, name, max_length)


def min_text_filter(df: DataFrame, minimum: int = MIN_TEXT_LENGTH, text: str = "text") -> DataFrame:
    return with_once(df, **{text: F.col(text)}).where(F.length(text) >= minimum)


def clean_items_keeping_raw(
    raw: DataFrame, low: float = MIN_PRICE, high: float = MAX_PRICE, minimum: int = MIN_TEXT_LENGTH,
    max_length: int | None = None,
) -> DataFrame:
    """Surviving listings with their raw columns plus ``price_value``, ``text``, ``weight``."""
    priced = raw.withColumn("price_value", parse_price(F.col("price"))).where(
        price_in_range(F.col("price_value"), low, high)
    )
    # The details are parsed once, for their text and for the weight.
    pair = details_pair(F.coalesce(F.col("details"), F.lit("")))
    parsed = with_once(priced, _pair=pair).withColumn("_entries", object_of(F.col("_pair")))
    kept = min_text_filter(build_text(parsed, max_length=max_length, entries="_entries"), minimum)
    weight = weight_pounds(last_value(F.col("_entries"), "Item Weight"))
    return kept.withColumn("weight", weight).drop("_entries", "_pair")


def clean_items(
    raw: DataFrame, low: float = MIN_PRICE, high: float = MAX_PRICE, minimum: int = MIN_TEXT_LENGTH,
    max_length: int | None = None,
) -> DataFrame:
    """Products: parsed price in range, long enough text, weight in pounds.

    Texts are cut only where the caller passes ``max_length``.
    """
    return clean_items_keeping_raw(raw, low, high, minimum, max_length).select(
        "product_id",
        F.coalesce("title", F.lit("")).alias("title"),
        "category",
        F.col("price_value").alias("price"),
        "text",
        "weight",
        F.lit(None).cast("string").alias("summary"),
    )


def label_rejects(
    raw: DataFrame, low: float = MIN_PRICE, high: float = MAX_PRICE, minimum: int = MIN_TEXT_LENGTH
) -> DataFrame:
    """Every raw row with the first reason it fails, null if it is kept.

    The text is built only where the price passed.
    """
    priced = raw.withColumn("_price", parse_price(F.col("price")))
    usable = F.coalesce(price_in_range(F.col("_price"), low, high), F.lit(False))
    texted = build_text(priced, when=usable, name="_text")
    reason = (
        F.when(F.col("_price").isNull(), BAD_PRICE)
        .when(~usable, OUT_OF_RANGE)
        .when(F.length("_text") < minimum, SHORT_TEXT)
    )
    return with_once(texted, reject_reason=reason).drop("_price", "_text")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, null when there is nothing to divide by."""
    return F.when(whole > 0, part * 100.0 / whole)


def price_validity_report(raw: DataFrame) -> DataFrame:
    price = F.col("_price")
    valid = F.coalesce(price_in_range(price), F.lit(False))
    counts = raw.select(parse_price(F.col("price")).alias("_price")).agg(
        F.count("*").alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(price.isNull()).alias("invalid"),
        F.count_if(price.isNotNull() & ~valid).alias("out_of_range"),
    )
    return counts.select(
        "*", *[percent(F.col(c), F.col("total")).alias(f"{c}_pct") for c in ("valid", "invalid", "out_of_range")]
    )


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Per category: raw, kept and rejected rows with their shares."""
    counts = label_rejects(raw).groupBy("category").agg(
        F.count("*").alias("raw_rows"),
        F.count_if(F.col("reject_reason").isNull()).alias("kept"),
    )
    rejected = F.col("raw_rows") - F.col("kept")
    return counts.select(
        "category", "raw_rows", "kept", rejected.alias("rejected"),
        percent(rejected, F.col("raw_rows")).alias("rejected_pct"),
        percent(F.col("kept"), F.col("raw_rows")).alias("kept_pct"),
    )


def grouped_report(raw: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows by category, split and reject reason: each pair with category, each alone, and all; one pass, one shuffle of sums.

    ``grouping`` is Spark's grouping id: a bit for each of the three that is summed over, so that a null that is
    meant (no reason: kept; no split: not in the dataset) is told from one that is not.
    """
    rows = label_rejects(raw).select("product_id", "category", F.col("reject_reason").alias("reason"))
    rows = rows.join(splits.select("product_id", "split"), "product_id", "left")
    sets = [["category", "split"], ["category", "reason"], ["category"], ["split"], ["reason"], []]
    keyed = [[F.col(c) for c in columns] for columns in sets]
    return rows.groupingSets(keyed, "category", "split", "reason").agg(
        F.grouping_id().cast("bigint").alias("grouping"), F.count("*").alias("items")).select("grouping", "category", "split", "reason", "items")


def before_after_sample(raw: DataFrame) -> DataFrame:
    """The first surviving row: raw price and text head beside the cleaned ones."""
    heads = F.concat(joined_list(raw, "description"), joined_list(raw, "features"))
    return clean_items_keeping_raw(raw).orderBy("product_id").limit(1).select(
        "product_id",
        F.col("price").alias("raw_price"),
        F.substring(heads, 1, 200).alias("raw_text"),
        F.col("price_value").alias("price"),
        "weight",
        F.substring("text", 1, 300).alias("text"),
    )
