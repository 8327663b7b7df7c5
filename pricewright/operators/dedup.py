"""Keep the first row per title, then per text, in shuffled order.

The winner of a group is the smallest (shuffle key, id), found by an
aggregate that combines before the shuffle: a title or text shared by a third
of all rows becomes one row per map task. Whole rows move once, to be matched
with the winning ids.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import SEED
from ..functions.hashing import hash52


def text_digest(text: Column) -> Column:
    """Stands for a long text as a group key; null for null."""
    return F.unhex(F.sha2(text, 256))


def own_text(products: DataFrame) -> Column:
    """What makes two products copies: the summary if there is one, else the text."""
    if "summary" not in products.columns:
        return F.col("text")
    return F.coalesce(F.nullif(F.col("summary"), F.lit("")), F.col("text"))


def _text_key(digest: Column, id_col: str) -> Column:
    """A missing text is no copy of another missing one: it is keyed by its id."""
    return F.coalesce(digest, F.encode(F.concat(F.lit("id "), F.col(id_col).cast("string")), "utf-8"))


def _index(products: DataFrame, id_col: str, seed: int, **keys: Column) -> DataFrame:
    rank = F.struct(hash52(seed, F.col(id_col)).alias("key"), F.col(id_col).alias("id"))
    return products.select(rank.alias("rank"), *[column.alias(name) for name, column in keys.items()])


def _first_per(index: DataFrame, key: str, *carried: str) -> DataFrame:
    """One row per key: that of the smallest rank."""
    # The rank leads the struct and is unique, so carried values never decide.
    first = F.min(F.struct("rank", *carried)).alias("first")
    return index.groupBy(key).agg(first).select("first.*")


def _keep(products: DataFrame, winners: DataFrame, id_col: str) -> DataFrame:
    return products.join(winners.select(F.col("rank.id").alias(id_col)), id_col, "left_semi")


def dedup_title(products: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    index = _index(products, id_col, seed, title=F.coalesce("title", F.lit("")))
    return _keep(products, _first_per(index, "title"), id_col)


def dedup_text(products: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    index = _index(products, id_col, seed, text=_text_key(text_digest(own_text(products)), id_col))
    return _keep(products, _first_per(index, "text"), id_col)


def survivor_index(
    products: DataFrame, *carried: str, id_col: str = "product_id", seed: int = SEED, digest: str | None = None
) -> DataFrame:
    """Ids left by both steps with the ``carried`` columns, without moving whole rows.

    If the text digest is stored in a column ``digest``, texts are not read.
    """
    index = _index(
        products, id_col, seed,
        title=F.coalesce("title", F.lit("")),
        text=_text_key(F.col(digest) if digest else text_digest(own_text(products)), id_col),
        carried=F.struct(F.lit(0).alias("_"), *carried),
    )
    by_title = _first_per(index, "title", "text", "carried")
    by_text = _first_per(by_title, "text", "carried")
    return by_text.select(F.col("rank.id").alias(id_col), *[F.col(f"carried.{c}").alias(c) for c in carried])


def dedup_title_then_text(products: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """Both steps on a narrow index; the rows themselves are joined once."""
    return products.join(survivor_index(products, id_col=id_col, seed=seed), id_col, "left_semi")


def dedup_report(products: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """Row counts before, after titles, and after texts."""
    index = _index(
        products, id_col, seed, title=F.coalesce("title", F.lit("")),
        text=_text_key(text_digest(own_text(products)), id_col),
    ).withColumn("rows", F.lit(1).cast("bigint"))
    # Each level carries along how many rows it stands for, so the table is read once.
    by_title = index.groupBy("title").agg(
        F.min(F.struct("rank", "text")).alias("first"), F.sum("rows").alias("rows")
    )
    by_text = by_title.groupBy("first.text").agg(F.sum("rows").alias("rows"), F.count("*").alias("titles"))
    return by_text.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("titles"), F.lit(0)).alias("after_title"),
        F.count("*").alias("after_text"),
    )
