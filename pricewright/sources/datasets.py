"""Split datasets at rest: parquet partitioned by split."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..constants import LITE_SPLIT_SIZES
from ..operators.splitting import lite_subset
from ..schemas import PRODUCT_FIELDS


def write_splits(splits: DataFrame, path: str) -> None:
    splits.write.mode("overwrite").partitionBy("split").parquet(path)


def write_lite(splits: DataFrame, path: str, sizes: dict[str, int] = LITE_SPLIT_SIZES) -> None:
    """A small copy: the first rows of each split."""
    write_splits(lite_subset(splits, sizes), path)


def write_prompts(prompts: DataFrame, path: str) -> None:
    write_splits(prompts.select("product_id", "split", "pos", "prompt", "completion"), path)


def read_split(spark: SparkSession, path: str, split: str | None = None, schema: StructType | None = None) -> DataFrame:
    """One split, reading its partition alone, or all of them."""
    reader = spark.read.schema(schema) if schema else spark.read
    stored = reader.parquet(path)
    return stored if split is None else stored.where(F.col("split") == split)


def verify_dataset(
    spark: SparkSession, path: str, expected: Sequence[str] = PRODUCT_FIELDS, schema: StructType | None = None
) -> DataFrame:
    """Per split: rows, expected fields that are missing, and its first row."""
    stored = read_split(spark, path, schema=schema)
    missing = F.array_except(
        F.array(*map(F.lit, expected)), F.array(*map(F.lit, stored.columns))
    )
    first = F.min_by(F.struct(F.substring("title", 1, 60).alias("title"), "price"), F.col("pos"))
    return (
        stored.groupBy("split")
        .agg(F.count("*").alias("items"), first.alias("first"))
        .select(
            "split", "items", F.array_join(missing, ",").alias("missing_fields"),
            F.col("first.title").alias("sample_title"), F.col("first.price").alias("sample_price"),
        )
    )
