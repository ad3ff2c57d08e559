"""Scoring: fitted models, and closed forms with given weights, centres or support vectors."""

from __future__ import annotations

from collections.abc import Sequence
from typing import ClassVar

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.functions.kernels import nearest, rbf_margin
from keyscore.functions.scalar import argmax2, logistic, weighted_sum
from keyscore.sources.documents import SvmParams, read_svm_model, write_svm_model
from keyscore.storage import fresh_path

# Bytes of support vectors that a task holds; what a model has beyond is read again for each batch of rows.
HELD_BYTES = 256 << 20


def score(df: DataFrame, model) -> DataFrame:
    """Add a fitted model's rawPrediction, probability and prediction columns."""
    return model.transform(df)


def score_linear(
    df: DataFrame, columns: Sequence[str], weights: Sequence[float], intercept: float, link: str = "logit"
) -> DataFrame:
    """margin = w . x + b; ``logit`` adds probability and predicts above 0.5, ``margin`` predicts above 0."""
    scored = df.withColumn("margin", weighted_sum([F.col(c) for c in columns], weights, intercept))
    if link == "logit":
        scored = scored.withColumn("probability", logistic(F.col("margin")))
        return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    if link == "margin":
        return scored.withColumn("prediction", (F.col("margin") > 0).cast("int"))
    raise ValueError("link must be 'logit' or 'margin'")


def score_softmax(
    df: DataFrame, columns: Sequence[str], weights: Sequence[Sequence[float]], intercepts: Sequence[float]
) -> DataFrame:
    """Two class probabilities p0, p1 of a dense softmax layer; predicts 1 where p1 > p0."""
    cols = [F.col(c) for c in columns]
    scored = df.withColumns(
        {f"_z{i}": weighted_sum(cols, w, b) for i, (w, b) in enumerate(zip(weights, intercepts))}
    )
    # subtracting the larger margin keeps exp in range
    top = F.greatest("_z0", "_z1")
    scored = scored.withColumns({"_e0": F.exp(F.col("_z0") - top), "_e1": F.exp(F.col("_z1") - top)})
    total = F.col("_e0") + F.col("_e1")
    scored = scored.withColumns({"p0": F.col("_e0") / total, "p1": F.col("_e1") / total})
    return scored.drop("_z0", "_z1", "_e0", "_e1").withColumn("prediction", argmax2(F.col("p0"), F.col("p1")))


def _as_array(df: DataFrame, features: str) -> Column:
    column = F.col(features)
    if isinstance(df.schema[features].dataType, VectorUDT):
        return F.when(column.isNotNull(), vector_to_array(column))
    return column.cast("array<double>")


def nearest_center(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Index of the closest centre (squared euclidean); centres are model parameters, held in memory."""
    return df.withColumn("prediction", nearest(_as_array(df, features), np.asarray(centers, dtype=float)))


def score_rbf_svm(
    df: DataFrame,
    sv_df: DataFrame,
    gamma: float,
    rho: float,
    labels: tuple[int, int] = (0, 1),
    features: str = "features",
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """margin = sum_i coef_i * exp(-gamma |x - v_i|^2) - rho; a positive margin gives the first label.

    ``sv_df`` holds ``coef, vector``. The vectors are sorted and written to the shared folder once; each task reads them
    block by block, in that order, and holds up to ``held_bytes`` of them. No join pairs rows with vectors.
    """
    x = _as_array(df, features)
    typed = sv_df.select(F.col("coef").cast("double").alias("coef"), F.col("vector").cast("array<double>").alias("vector"))
    path = fresh_path(df.sparkSession, "support-vectors")
    typed.orderBy("coef", "vector").write.parquet(path)
    size = df.sparkSession.read.parquet(path).agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    if not size.n:
        raise ValueError("the model has no support vectors")
    margin = rbf_margin(x, path, size.d, gamma, rho, held_bytes)
    scored = df.withColumn("margin", margin)
    return scored.withColumn("prediction", F.when(F.col("margin") > 0, labels[0]).otherwise(labels[1]))


class SvmTextModel:
    """A kernel-SVM, fitted or read from text, with the ``transform`` of a model: adds ``margin`` and ``prediction``."""

    #: Rows with null features are passed over; not a field.
    skips_null: ClassVar[bool] = True

    def __init__(self, params: SvmParams, sv_df: DataFrame):
        self.params, self.sv_df = params, sv_df

    @classmethod
    def load(cls, path: str) -> SvmTextModel:
        return cls(*read_svm_model(SparkSession.active(), path))

    def save(self, path: str) -> str:
        return write_svm_model(self.params, self.sv_df, path)

    def transform(self, df: DataFrame) -> DataFrame:
        return score_svm_model(df, self.params, self.sv_df)


def score_svm_model(df: DataFrame, params: SvmParams, sv_df: DataFrame, features: str = "features") -> DataFrame:
    """Score with a model read from its text file."""
    return score_rbf_svm(df, sv_df, params.gamma, params.rho, params.labels, features)
