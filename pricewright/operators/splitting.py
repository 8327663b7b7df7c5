"""Exact train, validation and test splits by shuffled position."""

from pyspark.sql import DataFrame, functions as F

from ..constants import LITE_SPLIT_SIZES, PROPORTIONAL_SPLIT_ENDS, SEED
from .ranking import with_position
from .sampling import share_of


def split_dataset(
    products: DataFrame, id_col: str = "product_id", seed: int = SEED,
    full_ends: tuple[int, int, int] | None = None,
    shares: tuple[float, float] = PROPORTIONAL_SPLIT_ENDS,
) -> DataFrame:
    """Add ``split`` and ``pos``, the 0-based position inside the split.

    The splits end at the given shares, rounded down, at any size. Only a caller
    who passes ``full_ends`` gets splits of these fixed sizes once there are
    ``full_ends[2]`` rows, and then the rest is dropped.
    """
    placed = with_position(products, id_col, seed, position="_place", total="_rows")
    place, rows = F.col("_place"), F.col("_rows")
    train_end, val_end = F.floor(rows * F.lit(shares[0])), F.floor(rows * F.lit(shares[1]))
    if full_ends is not None:
        full = rows >= full_ends[2]
        placed = placed.where(~full | (place < full_ends[2]))
        train_end = F.when(full, full_ends[0]).otherwise(train_end)
        val_end = F.when(full, full_ends[1]).otherwise(val_end)
    split = F.when(place < train_end, "train").when(place < val_end, "val").otherwise("test")
    first = F.when(place < train_end, 0).when(place < val_end, train_end).otherwise(val_end)
    return (
        placed.withColumn("split", split)
        .withColumn("pos", place - first)
        .drop("_place", "_rows")
    )


def split_report(splits: DataFrame) -> DataFrame:
    return share_of(splits, "split")


def lite_subset(splits: DataFrame, sizes: dict[str, int] = LITE_SPLIT_SIZES) -> DataFrame:
    """The first rows of each split by position."""
    wanted = F.lit(False)
    for split, size in sizes.items():
        wanted = wanted | ((F.col("split") == split) & (F.col("pos") < size))
    return splits.where(wanted)
