"""As-of join: to each row the last row of another table that came no later."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], time: str, value: Sequence[str], tie: str | None = None,
    within: int | None = None, bucket_seconds: int = 86_400,
) -> DataFrame:
    """``left`` with the columns ``value`` of the last row of ``right`` that agrees in ``by`` and is no later in ``time``; null without one.

    Of several at that time the one with the largest ``tie`` (or else value) counts; ``within`` seconds is how old it may be. Both tables are
    dealt once, by key and time bucket, so a hot key spreads over its buckets, each of which is one sorted window; what
    a bucket starts with is carried over from those before it, one row for each. Null keys and times agree with none.
    """
    value, by = list(value), list(by)
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    known = F.col("_t").isNotNull()
    for name in by:
        known = known & F.col(f"_by_{name}").isNotNull()
    keys = [f"_by_{name}" for name in by]

    def side(df: DataFrame, number: int, row: Column, found: Column) -> DataFrame:
        return df.select(
            *[F.col(name).alias(f"_by_{name}") for name in by], moment.alias("_t"), F.lit(number).alias("_side"), row.alias("_row"), found.alias("_found"))

    order = F.col(tie) if tie else F.struct(*value)
    answer = F.struct(moment.alias("at"), order.alias("tie"), F.struct(*value).alias("value"))
    rights = side(right, 0, F.lit(None), answer).where(known)
    lefts = side(left, 1, F.struct(*[F.col(c) for c in left.columns]), F.lit(None))
    rows = rights.drop("_row").unionByName(lefts.where(known), allowMissingColumns=True).withColumn(
        "_bucket", F.floor(F.col("_t") / (bucket_seconds * 1_000_000)))
    # The last answer of each bucket, handed on to the buckets after it.
    lasts = rows.groupBy(*keys, "_bucket").agg(F.max("_found").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).drop("_last")
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_t", "_side", F.col("_found.tie").asc_nulls_last())
    placed = rows.withColumn("_here", F.last("_found", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))).where("_side = 1")
    met = placed.join(carried, [*keys, "_bucket"], "left").withColumn("_answer", F.coalesce("_here", "_carried"))
    if within is not None:
        met = met.withColumn("_answer", F.when(F.col("_t") - F.col("_answer.at") <= within * 1_000_000, F.col("_answer")))
    met = met.select("_row", "_answer").unionByName(lefts.where(~known | known.isNull()).select("_row"), allowMissingColumns=True)
    return met.select("_row.*", *[F.col(f"_answer.value.{name}").alias(name) for name in value])
