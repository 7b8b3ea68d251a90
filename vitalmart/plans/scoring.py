"""Linear scoring: a model fitted by Spark aggregates and applied as a column.

All rows are used, in one scan: means and covariances of features and label are aggregates
that combine over tasks. Only that small matrix reaches the driver, where it is solved. Scores
are a sum of products inside the generated code; no row passes through Python.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_FEATURES = 30


@dataclass(frozen=True)
class LinearModel:
    """``intercept`` plus the sum of ``weights`` times features; ``r2`` of the rows learned."""

    intercept: float
    weights: dict[str, float]
    row_count: int
    r2: float | None

    def score(self, features: Mapping[str, Column]) -> Column:
        """The prediction; NULL where a feature is."""
        terms = [F.lit(w) * features[name].cast("double") for name, w in self.weights.items()]
        return reduce(Column.__add__, terms, F.lit(self.intercept))

    def as_rows(self, spark: SparkSession) -> DataFrame:
        """``term`` and ``weight``: the intercept and each feature."""
        rows = [("intercept", self.intercept), *self.weights.items()]
        return spark.createDataFrame(rows, "term string, weight double")


def fit_linear(df: DataFrame, features: Mapping[str, Column], label: Column) -> LinearModel:
    """Ordinary least squares of ``label`` on ``features``.

    Rows with a NULL in any of them are left out. A feature that is constant, or a sum of
    others, shares their weight (the smallest weights that fit). Without rows all weights are
    0 and ``r2`` is None. At most ``MOST_FEATURES`` features: the sums grow with their square.
    """
    if not 1 <= len(features) <= MOST_FEATURES:
        raise ValueError(f"one to {MOST_FEATURES} features")
    names = list(features)
    values = df.select(*[f.cast("double").alias(f"x{n}") for n, f in enumerate(features.values())], label.cast("double").alias("y")).dropna()
    columns = [*[f"x{n}" for n in range(len(names))], "y"]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = values.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if not sums["n"]:
        return LinearModel(0.0, dict.fromkeys(names, 0.0), 0, None)
    matrix = np.empty((len(columns), len(columns)))
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = sums[f"c{i}_{j}"]
    means = np.array([sums[f"mean_{c}"] for c in columns])
    # Features on one scale, so that small ones are not taken for constants.
    scale = np.sqrt(np.diag(matrix)[:-1])
    scale[scale == 0] = 1
    solved = np.linalg.lstsq(matrix[:-1, :-1] / np.outer(scale, scale), matrix[:-1, -1] / scale, rcond=1e-10)[0] / scale
    explained, spread = float(solved @ matrix[:-1, -1]), float(matrix[-1, -1])
    return LinearModel(
        float(means[-1] - solved @ means[:-1]), dict(zip(names, map(float, solved))), sums["n"], explained / spread if spread else None
    )
