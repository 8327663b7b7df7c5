"""Histograms and category profiles."""

from pyspark.sql import DataFrame, functions as F

from ..constants import LENGTH_BIN_COUNT, PRICE_BIN_COUNT, PRICE_BIN_WIDTH
from .barrier import with_once


def _all_bins(counts: DataFrame, bins: int) -> DataFrame:
    """Counts for every bin, empty ones included."""
    every = counts.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(F.broadcast(counts), "bin", "left").withColumn("items", F.coalesce("items", F.lit(0)))


def price_histogram(
    products: DataFrame, price: str = "price", width: int = PRICE_BIN_WIDTH, bins: int = PRICE_BIN_COUNT
) -> DataFrame:
    """Fixed-width bins from 0; the last includes its upper edge.

    One more row, of no upper edge, counts what lies in no bin: prices beyond
    the last, below 0, or absent. So the counts sum to the rows.
    """
    value, top = F.col(price), width * bins
    inside = F.least(F.floor(value / width), F.lit(bins - 1))
    counts = (
        products.select(F.when(value.between(0, top), inside).otherwise(F.lit(bins)).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("items"))
    )
    high = F.when(F.col("bin") < bins, (F.col("bin") + 1) * width)
    return _all_bins(counts, bins + 1).select("bin", (F.col("bin") * width).alias("low"), high.alias("high"), "items")


def length_histogram(values: DataFrame, value: str, bins: int = LENGTH_BIN_COUNT) -> DataFrame:
    """Equal-width bins over min..max, the last one closed.

    Equal values get a range of width 1 around them. A value is compared with
    the bin edges themselves, as the division may land next to one. Values are
    counted first, so a costly one is computed once per row.
    """
    known = with_once(values, _x=F.col(value).cast("double")).where("_x is not null")
    counts = known.groupBy("_x").agg(F.count("*").alias("_items"))
    # The sum keeps both uses of the counts alike, so that Spark runs them once.
    range_ = counts.agg(
        F.struct(F.min("_x").alias("low"), F.max("_x").alias("high"), F.sum("_items").alias("items"))
    ).scalar()
    low, high = range_.getField("low"), range_.getField("high")
    ranged = counts.select(
        "_x",
        "_items",
        F.when(low == high, low - 0.5).otherwise(low).alias("_low"),
        F.when(low == high, high + 0.5).otherwise(high).alias("_high"),
    ).withColumn("_step", (F.col("_high") - F.col("_low")) / bins)

    guess = F.least(F.floor((F.col("_x") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins), F.lit(bins - 1))

    def edge(index):
        return F.col("_low") + index * F.col("_step")

    placed = ranged.withColumn("_guess", guess)
    g = F.col("_guess")
    exact = (
        F.when((g > 0) & (F.col("_x") < edge(g)), g - 1)
        .when((g < bins - 1) & (F.col("_x") >= edge(g + 1)), g + 1)
        .otherwise(g)
    )
    filled = placed.groupBy(exact.alias("bin")).agg(F.sum("_items").alias("items"))
    return _all_bins(filled, bins).select("bin", "items")


def category_profile(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(
        F.count("*").alias("items"),
        F.avg("price").alias("mean_price"),
        F.avg(F.length("text")).alias("mean_text_length"),
    )
