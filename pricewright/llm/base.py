"""What the operators of this folder share."""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.session import scratch, ship_package, stage, stage_path

#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["BLANKS", "WORD", "fresh", "kept", "lower_ascii", "pieces_of", "read_table", "ship_package", "stage", "stage_path"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for own columns that clash with none of ``df``, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def pieces_of(amount: float, each: float, least: int = 1) -> int:
    """How many pieces of size ``each`` hold ``amount``; grows with the data, without an upper bound."""
    return max(least, math.ceil((amount or 0) / each))


def kept(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, stored; all that it stored on the way is deleted."""
    path = stage_path(spark, label)
    with scratch(spark):
        made = build()
        made.write.parquet(path)
        schema = made.schema
    return spark.read.schema(schema).parquet(path)
