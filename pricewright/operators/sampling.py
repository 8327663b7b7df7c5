"""Price- and category-weighted sampling without replacement, and reports."""

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import CATEGORY_MULTIPLIERS, PRICE_EPSILON, SEED
from ..functions.hashing import hash_uniform
from .barrier import with_once
from .cleaning import percent
from .ranking import log_bucket, smallest


def price_weight(products: DataFrame, name: str = "weight_price") -> DataFrame:
    """Squared price on a 0..1 scale of the whole table: the cheapest gets 0."""
    ends = products.agg(F.struct(F.min("price").alias("low"), F.max("price").alias("high"))).scalar()
    low, high = ends.getField("low"), ends.getField("high")
    # The ends enter every row once; what reads the weight finds it computed.
    scaled = with_once(products, _scaled=(F.col("price") - low) / ((high - low) + F.lit(PRICE_EPSILON)))
    return scaled.withColumn(name, F.col("_scaled") * F.col("_scaled")).drop("_scaled")


def multiplier_of(category: Column, multipliers: Mapping[str, float]) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(c), F.lit(float(m))) for c, m in multipliers.items()))
    return F.coalesce(F.try_element_at(table, category), F.lit(1.0))


def category_weight(
    products: DataFrame, multipliers: Mapping[str, float] | DataFrame = CATEGORY_MULTIPLIERS
) -> DataFrame:
    """The price weight times the multiplier of the category, 1.0 if unlisted.

    A mapping becomes a literal of the plan. A table (category, multiplier) is
    left-joined; Spark broadcasts it only while it is under its size limit.
    """
    weighed = price_weight(products)
    if isinstance(multipliers, DataFrame):
        joined = weighed.join(multipliers.select("category", "multiplier"), "category", "left")
        factor = F.coalesce("multiplier", F.lit(1.0))
        return joined.withColumn("sampling_weight", F.col("weight_price") * factor).drop("multiplier")
    factor = multiplier_of(F.col("category"), multipliers)
    return weighed.withColumn("sampling_weight", F.col("weight_price") * factor)


def weight_report(products: DataFrame, multipliers: Mapping[str, float] = CATEGORY_MULTIPLIERS) -> DataFrame:
    """Listed categories that occur: rows, and weight before and after."""
    return (
        category_weight(products, multipliers)
        .where(F.col("category").isin(*multipliers))
        .groupBy("category")
        .agg(
            F.count("*").alias("items"),
            F.sum("weight_price").alias("weight_before"),
            F.sum("sampling_weight").alias("weight_after"),
        )
        .withColumn("multiplier", multiplier_of(F.col("category"), multipliers))
    )


def sampling_probability(products: DataFrame, multipliers: Mapping[str, float] = CATEGORY_MULTIPLIERS) -> DataFrame:
    """Weight over total weight; null when no row has any weight."""
    weighed = category_weight(products, multipliers)
    total = weighed.agg(F.sum("sampling_weight")).scalar()
    return weighed.withColumn(
        "probability", F.when(total > 0, F.col("sampling_weight") / total)
    )


def select_by_weight(
    weighed: DataFrame, count: int, id_col: str = "product_id", weight_col: str = "sampling_weight", seed: int = SEED
) -> DataFrame:
    """Ids of min(count, rows with weight) rows, drawn without replacement.

    Each row gets an exponential key -ln(u) / w; the smallest keys win
    (Efraimidis and Spirakis 2006). Rows of weight 0 cannot be drawn.
    """
    key = -F.log(hash_uniform(seed, F.col(id_col))) / F.col(weight_col)
    keyed = weighed.where(F.col(weight_col) > 0).select(id_col, key.alias("_key"))
    return smallest(keyed, count, log_bucket(F.col("_key")), [F.col("_key"), F.col(id_col)]).select(id_col)


def fetch_selected(products: DataFrame, selected: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Full rows of the chosen ids."""
    return products.join(selected.select(id_col), id_col, "left_semi")


def weighted_sample(
    products: DataFrame, count: int, id_col: str = "product_id", seed: int = SEED,
    multipliers: Mapping[str, float] = CATEGORY_MULTIPLIERS,
) -> DataFrame:
    """Weigh and draw on id, price and category alone, then fetch the rows.

    Reads ``products`` several times, each time but the last only three
    columns: pass a stored table.
    """
    index = products.select(id_col, "price", "category")
    return fetch_selected(products, select_by_weight(category_weight(index, multipliers), count, id_col, seed=seed), id_col)


def share_of(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of ``key`` and their share of all rows in %."""
    counts = df.groupBy(key).agg(F.count("*").alias("items"))
    total = counts.agg(F.sum("items")).scalar()
    return counts.withColumn("share_pct", percent(F.col("items"), total))


def sample_distribution(products: DataFrame) -> DataFrame:
    return share_of(products, "category").orderBy(F.desc("items"), "category")


def eval_price_range(sample: DataFrame) -> DataFrame:
    return sample.agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"))
