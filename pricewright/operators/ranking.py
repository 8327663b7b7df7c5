"""Positions, running totals and exact selection without a global sort task.

Rows are cut into ordered buckets. A histogram of the buckets says how much
lies before each one; the order inside a bucket is settled by a window over
that bucket alone. Every row then knows its place in the whole table, and no
task ever sees more than a few buckets. The number of buckets is bounded
whatever the data: 2^16 for hashes, and by the exponent range of a double
(in practice some ten thousand) for values.

Each operator reads its input twice (histogram, then rows), so stage inputs
that are costly to compute.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import SEED
from ..functions.hashing import HASH_BITS, hash52
from .barrier import with_once

BUCKET_BITS = 16
BUCKETS_PER_UNIT = 1024  # per factor e
# Nulls sort first, so their bucket lies before any other.
NULL_BUCKET = -(1 << 62)


def hash_bucket(hashed: Column) -> Column:
    """Ordered bucket of a 52-bit hash; hashes fill buckets evenly."""
    return F.shiftright(hashed, HASH_BITS - BUCKET_BITS)


def value_bucket(value: Column) -> Column:
    """Ordered bucket of any number; NaN comes last, as in a sort."""
    magnitude = F.floor(F.log(F.abs(value) + 1) * BUCKETS_PER_UNIT)
    return (
        F.when(F.isnan(value.cast("double")), F.lit(1 << 40))
        .when(value < 0, -1 - magnitude)
        .otherwise(magnitude)
    )


def log_bucket(value: Column) -> Column:
    """Ordered bucket of a positive number that may be far below 1."""
    return F.floor(F.log(F.greatest(value, F.lit(1e-300))) * BUCKETS_PER_UNIT)


def _ordered(bucket: Column) -> Column:
    return F.coalesce(bucket.cast("bigint"), F.lit(NULL_BUCKET).cast("bigint"))


def _histogram(df: DataFrame, weight: Column) -> DataFrame:
    """Bucket, weight before it, weight in it, and the grand total."""
    # One task, but over the buckets only: their number is fixed above.
    everything = Window.partitionBy()
    earlier = everything.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return df.groupBy("_bucket").agg(F.sum(weight).alias("_inside")).select(
        "_bucket",
        F.coalesce(F.sum("_inside").over(earlier), F.lit(0)).alias("_before"),
        "_inside",
        F.sum("_inside").over(everything).alias("_total"),
    )


def with_running_total(
    df: DataFrame, bucket: Column, order: list[Column], weight: Column | None = None,
    before: str = "before", total: str = "total",
) -> DataFrame:
    """Add the weight of all earlier rows and of all rows (BIGINT weights).

    ``order`` must be total and ``bucket`` must never fall along it.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    bucketed = with_once(df, _bucket=_ordered(bucket))
    buckets = _histogram(bucketed, weight).select("_bucket", "_before", "_total")
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.join(F.broadcast(buckets), "_bucket")
        .withColumn(before, F.col("_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .withColumn(total, F.col("_total"))
        .drop("_bucket", "_before", "_total")
    )


def with_shuffle_key(df: DataFrame, id_col: str = "product_id", seed: int = SEED, name: str = "shuffle_key") -> DataFrame:
    return with_once(df, **{name: hash52(seed, F.col(id_col))})


def shuffle_rows(df: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """The whole table in seeded random order (a distributed range sort)."""
    return with_shuffle_key(df, id_col, seed).orderBy("shuffle_key", id_col).drop("shuffle_key")


def with_position(
    df: DataFrame, id_col: str = "product_id", seed: int = SEED, position: str = "pos", total: str = "n_rows"
) -> DataFrame:
    """0-based rank of each row in shuffled order, and the row count."""
    keyed = with_shuffle_key(df, id_col, seed, "_shuffle")
    order = [F.col("_shuffle"), F.col(id_col)]
    ranked = with_running_total(keyed, hash_bucket(F.col("_shuffle")), order, before=position, total=total)
    return ranked.drop("_shuffle")


def smallest(df: DataFrame, count: int, bucket: Column, order: list[Column]) -> DataFrame:
    """The ``count`` first rows by a total order, exactly.

    Whole buckets below the cut are kept by a filter, and rows are ranked in
    the one bucket that is cut, so that neither the driver nor one task has to
    hold ``count`` rows. The same path serves every count; nulls come first.
    """
    bucketed = with_once(df, _bucket=_ordered(bucket))
    cut = (
        _histogram(bucketed, F.lit(1).cast("bigint"))
        .where(F.col("_before") + F.col("_inside") >= count)
        .agg(F.min(F.struct("_bucket", "_before")).alias("cut"))
        .scalar()
    )
    last, before = cut.getField("_bucket"), cut.getField("_before")
    inside = Window.partitionBy("_bucket").orderBy(*order)
    below = bucketed.where(last.isNull() | (F.col("_bucket") < last)).drop("_bucket")
    at_cut = bucketed.where(F.col("_bucket") == last).withColumn("_rank", F.row_number().over(inside))
    return below.unionByName(at_cut.where(F.col("_rank") <= count - before).drop("_bucket", "_rank"))


def head_subset(df: DataFrame, count: int, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """The first ``count`` rows in shuffled order."""
    keyed = with_shuffle_key(df, id_col, seed, "_shuffle")
    order = [F.col("_shuffle"), F.col(id_col)]
    return smallest(keyed, count, hash_bucket(F.col("_shuffle")), order).drop("_shuffle")


def uniform_sample(df: DataFrame, count: int, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """min(count, n) rows without replacement; the same rows for every caller."""
    return head_subset(df, count, id_col, seed)


def upper_median(df: DataFrame, value: Column, name: str = "median") -> DataFrame:
    """One row: the element at n // 2 of the sorted non-null values.

    Works on value counts, so repeats cost nothing after partial aggregation.
    """
    values = with_once(df, _value=value).where("_value is not null")
    counts = values.groupBy("_value").agg(F.count("*").alias("_copies"))
    placed = with_running_total(
        counts, value_bucket(F.col("_value")), [F.col("_value")], F.col("_copies"), "_start", "_count"
    )
    middle = F.floor(F.col("_count") / 2)
    return placed.where(
        (F.col("_start") <= middle) & (middle < F.col("_start") + F.col("_copies"))
    ).select(F.col("_value").alias(name))
