"""Raw documents to a training mix: judged, cut, de-duplicated, decontaminated, mixed."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm.base import read_table, stage
from pricewright.llm.line_chunks import remove_repeated_runs
from pricewright.llm.mixing import mix_documents
from pricewright.llm.phrase_index import drop_contaminated
from pricewright.llm.simhash import keep_one_of_each
from pricewright.llm.site_quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site classifier does not reject."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the runs of lines that stand earlier; n_chars follows the text."""
    cut = remove_repeated_runs(docs)
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash or four fifths of common 5-word shingles link."""
    return keep_one_of_each(docs, alike=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document that is left."""
    return mix_documents(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier's fit and the fingerprints' hash are not to be had in SQL; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
