"""The queries of this folder, each an operator applied to its whole table."""

from pyspark.sql import DataFrame, SparkSession

from . import arc, line_chunks, passages, phrase_index, sharding, vector_codes
from .alignment import align_documents
from .base import read_table
from .collisions import nearest
from .density import page_texts
from .lattice import score_texts
from .mixing import mix_documents
from .simhash import simhash_groups
from .site_quality import site_quality

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(phrase_index.ORACLE)
def op1_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query()
def op2_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


@query()
def op3_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(read_table(spark, sf_dir, "pages"))


@query()
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"))


@query(arc.ORACLE)
def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(read_table(spark, sf_dir, "pages"))


@query()
def op6_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


@query()
def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query(passages.ORACLE)
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_digests(read_table(spark, sf_dir, "documents"))


@query(line_chunks.ORACLE)
def op9_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.chunk_digests(read_table(spark, sf_dir, "documents"))


@query()
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"))


@query(vector_codes.ORACLE)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(read_table(spark, sf_dir, "embeddings"))


@query(sharding.ORACLE)
def op13_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))
