"""Range join: points to the ranges that hold them, without comparing all with all, and counts of ranges without their pairs."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .barrier import with_once
from .ranking import value_bucket, with_running_total


def _level(length: Column, width: float) -> Column:
    """Bins of this level are as wide as ``width`` times two to its power, and no narrower than the range is long."""
    return F.ceil(F.log2(F.greatest(length / width, F.lit(1.0)))).cast("int")


def _bin(value: Column, level: Column, width: float) -> Column:
    return F.floor(value / (F.pow(F.lit(2.0), level) * width)).cast("bigint")


def _is_sound(low: Column, high: Column) -> Column:
    return (low <= high) & ~F.isnan(high) & (high - low < float("inf"))


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """All pairs of a row of ``points`` and one of ``ranges`` with ``low`` <= ``point`` <= ``high``; column names must differ.

    A range is filed in the at most two bins it touches, of the level whose bins are as wide as it is long; a point in one bin of
    every level that occurs, at most some sixty. They meet by (level, bin) and are then compared exactly, each pair once. ``width``
    is the finest bin; a good one is what a short range is long. Nulls, NaN and ranges that end before they begin meet nothing.
    """
    if not width > 0 or math.isinf(width):
        raise ValueError("bins need a width")
    bounds = [F.col(low).cast("double"), F.col(high).cast("double")]
    sound = ranges.where(_is_sound(*bounds))
    filed = with_once(sound, _level=_level(bounds[1] - bounds[0], width))
    levels = [r["_level"] for r in filed.select("_level").distinct().orderBy("_level").collect()]
    ends = [_bin(b, F.col("_level"), width) for b in bounds]
    filed = filed.withColumn("_bin", F.explode(F.sequence(*ends)))
    value = F.col(point).cast("double")
    places = F.array(*[F.struct(F.lit(n).alias("_level"), _bin(value, F.lit(n), width).alias("_bin")) for n in levels])
    placed = points.where(F.abs(value) < float("inf"))
    placed = placed.select("*", F.inline(places)) if levels else placed.select("*", F.lit(0).alias("_level"), F.lit(0).cast("bigint").alias("_bin")).where("false")
    met = placed.join(filed, ["_level", "_bin"]).where((F.col(low) <= F.col(point)) & (F.col(point) <= F.col(high)))
    return met.drop("_level", "_bin")


def range_counts(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Each row of ``ranges`` with ``items``, ``least`` and ``most`` of the points it holds, as ``range_join`` would pair them.

    The pairs of long ranges grow with points times ranges, so none is made. Points become a ladder: each distinct value with the points
    up to it, and a step from it to the next. The ends of ranges meet the step they lie on (at most two at a value), which tells
    the points below and up to them. ``width`` is the finest bin of that join; a good one is what a short step is long.
    """
    if not width > 0 or math.isinf(width):
        raise ValueError("bins need a width")
    value = F.col(point).cast("double")
    counted = points.where(F.abs(value) < float("inf")).groupBy(value.alias("_from")).agg(F.count("*").alias("_n"))
    # Read below for the places, the next values, and the ends of the ladder.
    counted = stage(counted, "range-values")
    order = [value_bucket(F.col("_from")), [F.col("_from")]]
    placed = with_running_total(with_running_total(counted, *order, F.col("_n"), "_below", "_points"), *order, None, "_place", "_values")
    ladder = stage(placed.drop("_points", "_values"), "range-ladder")
    following = ladder.select((F.col("_place") - 1).alias("_place"), F.col("_from").alias("_next"), F.col("_n").alias("_next_n"))
    steps = ladder.join(following, "_place", "left").select(
        "_from", F.coalesce("_next", "_from").alias("_to"), "_below", "_n", F.coalesce("_next_n", F.lit(0)).alias("_next_n"))
    bounds = [F.col(low).cast("double"), F.col(high).cast("double")]
    sound = _is_sound(*bounds)
    ends = ranges.where(sound).select(F.explode(F.array(*bounds)).alias("_end")).distinct()
    at_start, at_end = F.col("_end") == F.col("_from"), F.col("_end") == F.col("_to")
    upto = F.col("_below") + F.col("_n")
    met = range_join(ends, steps, "_end", "_from", "_to", width).groupBy("_end").agg(
        F.min(F.when(at_start, F.col("_below")).otherwise(upto)).alias("_under"),
        F.max(F.when(at_end, upto + F.col("_next_n")).otherwise(upto)).alias("_upto"),
        F.min(F.when(at_start, F.col("_from")).otherwise(F.col("_to"))).alias("_ceiling"),
        F.max(F.when(at_end, F.col("_to")).otherwise(F.col("_from"))).alias("_floor"),
    )
    # Ends beyond the ladder meet no step.
    whole = counted.agg(F.struct(F.min("_from").alias("first"), F.max("_from").alias("last"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))).scalar()
    known = with_once(ends.join(met, "_end", "left"), _whole=whole)
    below, above = F.col("_end") < F.col("_whole.first"), F.col("_end") > F.col("_whole.last")
    known = stage(known.select(
        "_end",
        F.when(below, 0).when(above, F.col("_whole.n")).otherwise(F.coalesce("_under", F.lit(0))).alias("_under"),
        F.when(below, 0).when(above, F.col("_whole.n")).otherwise(F.coalesce("_upto", F.lit(0))).alias("_upto"),
        F.when(below, F.col("_whole.first")).otherwise(F.col("_ceiling")).alias("_ceiling"),
        F.when(above, F.col("_whole.last")).otherwise(F.col("_floor")).alias("_floor"),
    ), "range-ends")
    starts = known.select(F.col("_end").alias("_low"), "_under", "_ceiling")
    tops = known.select(F.col("_end").alias("_high"), "_upto", "_floor")
    found = ranges.select("*", *[F.when(sound, b).alias(n) for b, n in zip(bounds, ("_low", "_high"))]).join(starts, "_low", "left").join(tops, "_high", "left")
    items = F.coalesce(F.col("_upto") - F.col("_under"), F.lit(0))
    return found.select(*ranges.columns, items.alias("items"), F.when(items > 0, F.col("_ceiling")).alias("least"), F.when(items > 0, F.col("_floor")).alias("most"))
