"""Numeric features and bag-of-words features."""

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import VOCABULARY_SIZE
from ..functions.text import WORD, effective_text
from .barrier import with_once

NUMERIC = ("weight", "weight_missing", "text_length")
BOW_TOKEN = rf"[{WORD}]{{2,}}"


def numeric_features(products: DataFrame) -> DataFrame:
    """Weight (0 if unknown), whether it is unknown, and the length of the text."""
    weight = F.coalesce("weight", F.lit(0.0))
    text = effective_text(F.col("summary"), F.col("text"))
    return products.withColumns({
        "weight": weight,
        "weight_missing": (weight == 0).cast("int"),
        "text_length": F.length(text).cast("bigint"),
    })


def english_stop_words() -> list[str]:
    """Spark's own English list; any other list can be passed instead."""
    return StopWordsRemover.loadDefaultStopWords("english")


def word_list(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case words of two or more word characters, stop words removed."""
    found = F.regexp_extract_all(F.lower(text), F.lit(BOW_TOKEN), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda word: ~word.isin(*stop_words))


def bow_tokens(products: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    stop_words = english_stop_words() if stop_words is None else stop_words
    # An explode filters out empty lists first, and would cut the text twice.
    return with_once(products, tokens=word_list(effective_text(F.col("summary"), F.col("text")), stop_words))


def bow_vocabulary(tokenized: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The most frequent terms by total count, ties by term, numbered alphabetically.

    Counting combines before the shuffle, so a term in every row costs no more.
    """
    top = (
        tokenized.select(F.explode("tokens").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "term")
        .limit(size)
    )
    # One task over at most ``size`` rows.
    index = F.row_number().over(Window.partitionBy().orderBy("term")) - 1
    return top.withColumn("term_index", index.cast("bigint"))


def vocabulary_terms(vocabulary: DataFrame) -> list[str]:
    """The terms in index order. Bounded by the vocabulary size."""
    return [row.term for row in vocabulary.select("term", "term_index").orderBy("term_index").collect()]


def bow_vectors(tokenized: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Sparse counts on a given vocabulary; a narrow step."""
    model = CountVectorizerModel.from_vocabulary(list(terms), inputCol="tokens", outputCol="bow")
    return model.transform(tokenized)


def bow_counts(tokenized: DataFrame, vocabulary: DataFrame, id_col: str = "product_id") -> DataFrame:
    """The same counts as rows (id, term, term_index, occurrences).

    Words are counted inside their row, so nothing but found terms leaves it;
    terms enter the plan as one list, bounded by the vocabulary.
    """
    terms = vocabulary_terms(vocabulary)
    vectors = bow_vectors(tokenized, terms)
    cells = vectors.select(id_col, F.inline(_cells(F.col("bow"))))
    names = F.array(*[F.lit(term) for term in terms])
    return cells.select(
        id_col, F.get(names, F.col("index")).alias("term"), F.col("index").cast("bigint").alias("term_index"),
        F.col("value").cast("bigint").alias("occurrences"),
    )


def _cells(vector: Column) -> Column:
    """Index and value of the cells of a sparse vector that are not 0; its cost is that of the words of the row."""
    sparse = F.unwrap_udt(vector)
    return F.transform(sparse["indices"], lambda index, i: F.struct(index.alias("index"), F.get(sparse["values"], i).alias("value")))


def bow_matrix_stats(tokenized: DataFrame, vocabulary: DataFrame, first: int = 400, last: int = 410) -> DataFrame:
    """Rows, terms, share of zero cells, and the terms numbered ``first``..``last - 1``."""
    # One pass over the texts counts the rows and, inside each row, its terms.
    vectors = bow_vectors(tokenized, vocabulary_terms(vocabulary))
    filled = vectors.agg(F.struct(
        F.count("*").alias("items"),
        F.coalesce(F.sum(F.size(_cells(F.col("bow")))), F.lit(0)).cast("bigint").alias("filled"),
    )).scalar()
    size = vocabulary.agg(
        F.count("*").alias("terms"),
        F.array_sort(F.collect_list(F.when(F.col("term_index").between(first, last - 1), F.col("term")))).alias("sample_terms"),
    )
    return with_once(size, _filled=filled).select(
        F.col("_filled.items").alias("items"), "terms", F.col("_filled.filled").alias("filled"), "sample_terms"
    ).withColumn(
        "zero_pct",
        F.when((F.col("items") > 0) & (F.col("terms") > 0),
               100.0 * (1 - F.col("filled") / (F.col("items").cast("double") * F.col("terms")))),
    )
