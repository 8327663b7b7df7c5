"""Baseline pricers, fitted and applied as DataFrame jobs.

Every fit returns a :class:`Pricer`: a name and a function that adds a
``predicted`` column, floored at 0 where the model can go below.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..constants import IMPORTANT_WORDS, SEED
from ..functions.hashing import hash_uniform
from ..session import scratch, ship_package, stage
from .boosting import cells, fit_boosted_trees, with_trees
from .features import NUMERIC, bow_tokens, bow_vectors, numeric_features
from .forest import fit_forest, with_forest
from .least_squares import fit_least_squares, with_fitted
from .ranking import head_subset, upper_median

VALIDATION = "_validation"


@dataclass
class Pricer:
    name: str
    apply: Callable[[DataFrame], DataFrame]
    model: object = None
    terms: Sequence[str] = field(default_factory=tuple)

    def predict(self, products: DataFrame) -> DataFrame:
        return self.apply(products)


def price_stats(train: DataFrame) -> DataFrame:
    """Mean, upper median and population standard deviation of the price."""
    return train.agg(
        F.avg("price").alias("mean_price"), F.stddev_pop("price").alias("std_price")
    ).withColumn("median_price", upper_median(train, F.col("price")).scalar())


def random_pricer(id_col: str = "product_id", seed: int = SEED) -> Pricer:
    """A whole price 1..999 that depends on the seed and the id only."""
    guess = (F.lit(1) + F.floor(hash_uniform(seed, F.col(id_col)) * 999)).cast("double")
    return Pricer("seeded guess", lambda df: df.withColumn("predicted", guess))


def constant_pricer(train: DataFrame) -> Pricer:
    """The mean train price for every row, as a subquery of the plan."""
    mean = train.agg(F.avg("price"))
    return Pricer("mean price", lambda df: df.withColumn("predicted", mean.scalar()))


def _floored(df: DataFrame, *scratch: str) -> DataFrame:
    return df.withColumn("predicted", F.greatest(F.col("_prediction"), F.lit(0.0))).drop("_prediction", *scratch)


def linear_numeric(train: DataFrame) -> Pricer:
    """Ordinary least squares on the three numeric features, in one pass."""
    assembler = VectorAssembler(inputCols=list(NUMERIC), outputCol="_features")

    def assembled(df: DataFrame) -> DataFrame:
        return assembler.transform(numeric_features(df))

    fit = LinearRegression(
        featuresCol="_features", labelCol="price", predictionCol="_prediction", solver="normal", regParam=0.0
    ).fit(assembled(train).select("_features", "price"))

    def apply(df: DataFrame) -> DataFrame:
        features = assembled(df.select("*", F.struct("*").alias("_row"))).select("_row", "_features")
        return _floored(fit.transform(features), "_features").select("_row.*", "predicted")

    return Pricer("least squares on numbers", apply, fit, NUMERIC)


def coefficients(pricer: Pricer, spark) -> DataFrame:
    """Coefficient per feature, plus the intercept. Bounded by the feature count."""
    rows = [(name, float(value)) for name, value in zip(pricer.terms, pricer.model.coefficients)]
    return spark.createDataFrame(rows + [("intercept", float(pricer.model.intercept))], "feature string, coefficient double")


def _bow_pricer(name: str, train: DataFrame, terms: Sequence[str], fit: Callable, apply: Callable, keep: Sequence[str] = ()) -> Pricer:
    """A pricer on word counts: ``fit(rows)`` makes the model from stored rows, ``apply(rows, model)`` adds ``_prediction``.

    Rows that come with a column ``bow``, their counts on the same terms, need no text; if several fits learn from them, store them once.
    """
    def vectors(df: DataFrame) -> DataFrame:
        return df if "bow" in df.columns else bow_vectors(bow_tokens(df), terms)

    def apply_floored(df: DataFrame) -> DataFrame:
        return _floored(apply(vectors(df), model), *(c for c in ("tokens", "bow") if c not in df.columns))

    with scratch(train.sparkSession):
        # Fits may pass over the vectors many times; the text is tokenized once.
        rows = vectors(train).select("product_id", "bow", "price", *keep)
        model = fit(rows if "bow" in train.columns else stage(rows, "bow"))
    return Pricer(name, apply_floored, model, tuple(terms))


def linear_bow(train: DataFrame, terms: Sequence[str], tolerance: float = 1e-10) -> Pricer:
    """Least squares on word counts, of least norm where the words do not determine it; one pass over the rows."""
    return _bow_pricer("least squares on words", train, terms, lambda rows: fit_least_squares(rows, tolerance=tolerance), with_fitted)


def random_forest(
    train: DataFrame, terms: Sequence[str], rows: int | None = None, trees: int = 100, depth: int = 30, seed: int = SEED, bins: int = 16,
) -> Pricer:
    """Bagged trees over all features on all train rows, or on the first ``rows`` of them if so many are named (see ``forest``)."""
    def fit(staged: DataFrame):
        inside = cells(F.col("bow"))
        sparse = staged.select(F.col("product_id").cast("string").alias("id"), F.col("price").cast("double").alias("price"),
                               inside["indices"].alias("indices"), inside["values"].alias("values"))
        return fit_forest(sparse, len(terms), trees, depth, seed, bins)

    return _bow_pricer("bagged trees", train if rows is None else head_subset(train, rows), terms, fit, with_forest)


def boosted_trees(
    train: DataFrame, terms: Sequence[str], rounds: int = 1000, rate: float = 0.1, depth: int = 6,
    validation: DataFrame | None = None, patience: int = 10, penalty: float = 1.0,
) -> Pricer:
    """Trees fitted one after another to the remaining error, on all train rows (see ``boosting``).

    With ``validation`` rows the fit ends once ``patience`` rounds in a row have not lowered their error, and keeps the trees up to the lowest.
    ``model.rounds`` and ``model.errors`` tell how far it came.
    """
    marked = [train.withColumn(VALIDATION, F.lit(False))]
    if validation is not None:
        marked.append(validation.withColumn(VALIDATION, F.lit(True)))

    def fit(rows: DataFrame):
        inside = cells(F.col("bow"))
        sparse = rows.select(F.col("price").cast("double").alias("price"), F.col(VALIDATION).alias("held"),
                             inside["indices"].alias("indices"), inside["values"].alias("values"))
        return fit_boosted_trees(sparse, len(terms), rounds, rate, depth, penalty, patience=patience if validation is not None else None)

    return _bow_pricer("boosted trees", reduce(DataFrame.unionByName, marked), terms, fit, with_trees, [VALIDATION])


def top_words(pricer: Pricer, spark, count: int = 5) -> DataFrame:
    """Words with the largest and the smallest coefficients."""
    words = coefficients(pricer, spark).where("feature <> 'intercept'")
    up = words.orderBy(F.desc("coefficient"), "feature").limit(count).withColumn("effect", F.lit("increases"))
    down = words.orderBy("coefficient", "feature").limit(count).withColumn("effect", F.lit("decreases"))
    return up.unionByName(down)


def feature_importance(pricer: Pricer, spark, count: int = IMPORTANT_WORDS) -> DataFrame:
    """The most important words of a tree model, ranked."""
    rows = [(term, float(value)) for term, value in zip(pricer.terms, pricer.model.featureImportances.toArray())]
    words = spark.createDataFrame(rows, "word string, importance double")
    top = words.orderBy(F.desc("importance"), "word").limit(count)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(F.desc("importance"), "word")))


_loaded: dict[str, Callable[[pd.DataFrame], Sequence]] = {}


def _load_once(key: str, load: Callable[[], Callable]) -> Callable:
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def batch_predict(
    df: DataFrame, key: str, load: Callable[[], Callable[[pd.DataFrame], Sequence]], inputs: Sequence[str],
    output_type: T.DataType = T.DoubleType(), output: str = "predicted",
) -> DataFrame:
    """Any predictor over a table, in Arrow batches of ``inputs``; other columns stay in the JVM.

    ``load`` runs once per Python worker and ``key``; the predictor it returns
    takes a pandas frame. A row that fails gets 0 and ``<output>_failed`` true,
    and does not take the rest of its batch with it. A batch of several rows
    that all fail is no failure of a row: its error is raised.
    """
    ship_package(df.sparkSession)
    inputs = list(inputs)
    fallback = "0" if isinstance(output_type, T.StringType) else 0.0

    def answers(predict, frame: pd.DataFrame) -> list[tuple]:
        """Halve a failing batch until its failing rows stand alone."""
        try:
            return [(value, None) for value in predict(frame)]
        except Exception as error:
            if len(frame) == 1:
                return [(fallback, error)]
            middle = len(frame) // 2
            return answers(predict, frame.iloc[:middle]) + answers(predict, frame.iloc[middle:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = _load_once(key, load)
        for batch in batches:
            found = answers(predict, batch) if len(batch) else []
            errors = [error for _, error in found if error is not None]
            if len(found) > 1 and len(errors) == len(found):
                raise errors[0]
            yield pd.DataFrame({"value": [v for v, _ in found], "failed": [e is not None for _, e in found]})

    answer = F.pandas_udf(run, T.StructType([T.StructField("value", output_type), T.StructField("failed", T.BooleanType())]))
    scored = df.withColumn("_answer", answer(F.struct(*inputs)))
    return scored.withColumns({output: F.col("_answer.value"), f"{output}_failed": F.col("_answer.failed")}).drop("_answer")
