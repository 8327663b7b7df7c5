"""De-duplication across ingests: a stored index of titles is merged with each new one.

The index has a row per title: the rank, id and text of the row that wins it. It is bucketed by title, so a merge
shuffles the new rows' keys only, and neither the rows nor the keys of earlier ingests.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import SEED
from ..session import stage_path
from .dedup import _first_per, _index, _text_key, own_text, text_digest


def title_winners(products: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """Per title (null counts as empty) the row of the smallest rank: title, rank, text (its digest, or its id without a text)."""
    index = _index(products, id_col, seed, title=F.coalesce("title", F.lit("")), text=_text_key(text_digest(own_text(products)), id_col))
    return index.groupBy("title").agg(F.min(F.struct("rank", "text")).alias("first")).select("title", "first.*")


def merged_winners(index: DataFrame, products: DataFrame, id_col: str = "product_id", seed: int = SEED) -> DataFrame:
    """The index after one more ingest; of an id that comes again the row counts once."""
    new = title_winners(products, id_col, seed).select("title", F.struct("rank", "text").alias("_new"))
    old = index.select("title", F.struct("rank", "text").alias("_old"))
    return old.join(new, "title", "full").select("title", F.inline(F.array(F.least("_old", "_new"))))


def store_index(winners: DataFrame, path: str | None = None, buckets: int | None = None) -> str:
    """Store an index as a new bucketed table, and return its name; ``read_index`` reads it.

    There should be as many ``buckets`` as shuffle partitions (the default), or a merge would deal the index anew.
    """
    spark = winners.sparkSession
    name = f"title_index_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    winners.write.bucketBy(buckets, "title").sortBy("title").option("path", path or stage_path(spark, "title-index")).saveAsTable(name)
    return name


def read_index(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ingest(spark: SparkSession, name: str | None, products: DataFrame, id_col: str = "product_id", seed: int = SEED, buckets: int | None = None) -> str:
    """Merge one ingest into the index of that name (None: the first); returns the new index's name. The old one stays as it is, so a failed ingest is repeated."""
    winners = title_winners(products, id_col, seed) if name is None else merged_winners(read_index(spark, name), products, id_col, seed)
    return store_index(winners, buckets=buckets)


def ingested_survivors(index: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Ids left by both steps over all ingests: of the rows that win their titles the first of each text."""
    return _first_per(index.select("text", "rank"), "text").select(F.col("rank.id").alias(id_col))
