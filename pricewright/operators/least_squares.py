"""Least squares on sparse counts in one pass, whatever the rank."""

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F


@dataclass
class LeastSquares:
    coefficients: np.ndarray
    intercept: float
    rank: int


def fit_least_squares(rows: DataFrame, features: str = "bow", label: str = "price", tolerance: float = 1e-10) -> LeastSquares:
    """The solution of least norm, on features scaled to unit deviation, with an intercept.

    One pass sums the products of all pairs of columns (features, 1, label); its matrix is bounded by the vocabulary. The driver
    splits the centred, scaled matrix into eigenvectors and solves on those whose eigenvalue is at least ``tolerance`` of the
    largest. Their number is the rank, so features that depend on others share their effect, and constant ones get 0.
    """
    assembler = VectorAssembler(inputCols=[features, "_one", label], outputCol="_all")
    whole = assembler.transform(rows.withColumn("_one", F.lit(1.0))).select("_all")
    products = np.array(RowMatrix(MLUtils.convertVectorColumnsFromML(whole, "_all")).computeGramianMatrix().toArray())
    n, means = products[-2, -2], products[-2] / max(products[-2, -2], 1)
    centred = products - n * np.outer(means, means)
    matrix, moments = centred[:-2, :-2], centred[:-2, -1]
    spread = np.sqrt(np.maximum(matrix.diagonal(), 0))
    # A feature that never varies leaves only rounding behind.
    varies = spread > 1e-7 * np.sqrt(np.maximum(products.diagonal()[:-2], 1e-300))
    scale = np.where(varies, spread, 1.0)
    scaled = np.where(np.outer(varies, varies), matrix / np.outer(scale, scale), 0.0)
    values, vectors = np.linalg.eigh(scaled)
    used = values > tolerance * max(values[-1], 1e-300)
    solved = vectors[:, used] @ ((vectors[:, used].T @ np.where(varies, moments / scale, 0.0)) / values[used]) / scale
    return LeastSquares(solved, float(means[-1] - solved @ means[:-2]), int(used.sum()))


def with_fitted(df: DataFrame, model: LeastSquares, features: str = "bow", output: str = "_prediction") -> DataFrame:
    """Add the fitted value of each row; all of it stays in the JVM."""
    weighed = ElementwiseProduct(scalingVec=Vectors.dense(model.coefficients), inputCol=features, outputCol="_weighed").transform(df)
    total = F.aggregate(F.unwrap_udt("_weighed")["values"], F.lit(0.0), lambda a, b: a + b)
    return weighed.withColumn(output, total + F.lit(model.intercept)).drop("_weighed")
