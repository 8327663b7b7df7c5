"""Raw listings to a split dataset.

Whole rows are written once after cleaning, with a digest of their text, and
read and moved once at the end. All that lies between (de-duplication, weights,
the draw, positions) reads narrow columns.
"""

from pyspark.sql import DataFrame, functions as F

from ..constants import SEED
from ..operators.cleaning import clean_items
from ..operators.dedup import own_text, survivor_index, text_digest
from ..operators.sampling import category_weight, select_by_weight
from ..operators.splitting import split_dataset
from ..session import scratch, stage
from ..sources.datasets import write_lite, write_splits


def assign_splits(products: DataFrame, sample_size: int | None = None, seed: int = SEED) -> DataFrame:
    """(product_id, split, pos) of the rows that are unique and, if a size is given, drawn."""
    digest = "text_digest" if "text_digest" in products.columns else None
    unique = stage(survivor_index(products, "price", "category", seed=seed, digest=digest), "unique")
    if sample_size is None:
        return split_dataset(unique.select("product_id"), seed=seed)
    drawn = stage(select_by_weight(category_weight(unique), sample_size, seed=seed), "drawn")
    return split_dataset(drawn, seed=seed)


def split_listings(
    raw: DataFrame, sample_size: int | None = None, seed: int = SEED, max_length: int | None = None
) -> DataFrame:
    """Clean, de-duplicate, draw, shuffle and split.

    Runs jobs before it returns: the cleaned rows, the unique index and the
    draw are stored. Without ``sample_size`` every unique row is kept.
    """
    cleaned = clean_items(raw, max_length=max_length)
    products = stage(cleaned.withColumn("text_digest", text_digest(own_text(cleaned))), "products")
    return products.join(assign_splits(products, sample_size, seed), "product_id").drop("text_digest")


def publish_listings(
    raw: DataFrame, path: str, lite_path: str | None = None, sample_size: int | None = None, seed: int = SEED,
    max_length: int | None = None,
) -> None:
    """Write the split dataset, and its lite form; what was stored on the way is deleted."""
    spark = raw.sparkSession
    with scratch(spark):
        write_splits(split_listings(raw, sample_size, seed, max_length), path)
    if lite_path:
        write_lite(spark.read.parquet(path), lite_path)
