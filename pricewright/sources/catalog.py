"""Raw listings: stored by category, read, numbered, ingested."""

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..constants import CATEGORIES
from ..operators.barrier import with_once
from ..operators.cleaning import clean_items
from ..operators.ranking import with_running_total
from ..schemas import RAW_LISTING
from ..session import stage

COPIES_PER_CHUNK = 100_000


def read_catalogs(spark: SparkSession, path: str, categories: Iterable[str] | None = None) -> DataFrame:
    """Listings of all stored categories as one table, or of some; other partitions are not read."""
    listings = spark.read.schema(RAW_LISTING).parquet(path)
    return listings if categories is None else listings.where(F.col("category").isin(*categories))


def read_catalog(spark: SparkSession, path: str, category: str) -> DataFrame:
    return read_catalogs(spark, path, [category])


def union_catalogs(catalogs: Mapping[str, DataFrame]) -> DataFrame:
    """Separate tables, one per category, as one with the category attached."""
    return reduce(DataFrame.unionByName, [df.withColumn("category", F.lit(c)) for c, df in catalogs.items()])


def write_catalog(raw: DataFrame, path: str) -> None:
    raw.write.mode("overwrite").partitionBy("category").parquet(path)


def with_product_id(raw: DataFrame) -> DataFrame:
    """Number rows 0, 1, ... in the order of a digest of all their fields.

    The same rows get the same ids at any partitioning. Copies of one row
    become a single counted row before the shuffle and are spread again in
    chunks, so a row repeated a billion times burdens no task.
    """
    fields = raw.columns
    digest = F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
    digested = with_once(raw, _digest=digest)
    # Numbering needs the digests alone; the rows follow, one per distinct digest.
    counts = stage(digested.groupBy("_digest").agg(F.count("*").alias("_copies")), "digests")
    bucket = F.conv(F.substring("_digest", 1, 4), 16, 10).cast("bigint")
    numbered = with_running_total(counts, bucket, [F.col("_digest")], F.col("_copies"), "_start", "_count")
    rows = digested.groupBy("_digest").agg(F.first(F.struct(*fields)).alias("_row"))
    # Rows stay where the join puts them, unless their copies fill several chunks.
    one_chunk = F.col("_copies") <= COPIES_PER_CHUNK
    placed = rows.join(numbered, "_digest")
    few = placed.where(one_chunk).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
    last_chunk = F.floor((F.col("_copies") - 1) / COPIES_PER_CHUNK)
    chunks = placed.where(~one_chunk).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    first = F.col("_chunk") * COPIES_PER_CHUNK
    last = F.least(first + COPIES_PER_CHUNK, F.col("_copies")) - 1
    many = chunks.repartition("_digest", "_chunk").withColumn("_copy", F.explode(F.sequence(first, last))).drop("_chunk")
    return few.unionByName(many).select((F.col("_start") + F.col("_copy")).alias("product_id"), "_row.*")


def describe_raw(raw: DataFrame, index: int = 0, width: int = 100) -> DataFrame:
    """Column names and value heads of the row at ``index`` by product id.

    The ids alone say which row that is; the scan of whole rows then skips
    every row group that cannot hold it.
    """
    first = raw.select("product_id").orderBy("product_id").limit(index + 1)
    chosen = first.agg(F.when(F.count("*") == index + 1, F.max("product_id"))).scalar()
    entries: list[Column] = [
        F.struct(F.lit(name).alias("column"), F.substring(F.col(name).cast("string"), 1, width).alias("value"))
        for name in raw.columns
    ]
    return raw.where(F.col("product_id") == chosen).select(F.inline(F.array(*entries)))


def stored_categories(spark: SparkSession, path: str) -> set[str]:
    """Categories whose write finished. One listing entry per category."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return set()
    names = [entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory()]
    return {
        name.removeprefix("category=") for name in names
        if name.startswith("category=") and files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS"))
    }


def ingest_missing(
    spark: SparkSession, load: Callable[[str], DataFrame], path: str, categories: Iterable[str] = CATEGORIES,
    prepare: Callable[[DataFrame], DataFrame] = clean_items,
) -> DataFrame:
    """Prepare and store each category that is not stored yet.

    A category counts as stored once its write has committed, so an
    interrupted run resumes; one that fails is reported and the others go on.
    """
    stored = stored_categories(spark, path)
    report = []
    for category in categories:
        if category in stored:
            report.append((category, "already stored", None, None, None))
            continue
        raw_seen, kept_seen = Observation(), Observation()
        try:
            raw = load(category).observe(raw_seen, F.count(F.lit(1)).alias("rows"))
            kept = prepare(raw).observe(kept_seen, F.count(F.lit(1)).alias("rows"))
            kept.drop("category").write.mode("overwrite").parquet(f"{path}/category={category}")
            report.append((category, "stored", raw_seen.get["rows"], kept_seen.get["rows"], None))
        except Exception as error:
            # Whatever the loader raises is reported with its kind, so that a slip of the program shows as one.
            report.append((category, "failed", None, None, f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}"))
    return spark.createDataFrame(
        report, "category string, status string, raw_rows bigint, kept bigint, error string"
    )
