"""A softmax layer trained in epochs of mini-batches, with a listener that hears the loss while it trains."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.functions.scalar import logistic, weighted_sum
from keyscore.operators.boosting import as_array
from keyscore.storage import fresh_path

#: Files of a mini-batch, so that its gradient is not the work of one task.
FILES = 8

#: Called with the step, the mean loss of its mini-batch and the weights that gave it.
Listener = Callable[[int, float, "SoftmaxLayer"], None]


@dataclass(frozen=True)
class SoftmaxLayer:
    """Two classes; the weights of class 0 are those of class 1 with the other sign. ``transform`` adds ``p1`` and ``prediction``."""

    #: Rows with null features are passed over; not a field.
    skips_null: ClassVar[bool] = True

    weights: tuple[float, ...]
    intercept: float
    features: str = "features"

    def margin(self, x: Column) -> Column:
        """How far class 1 is above class 0."""
        return weighted_sum([x[i] for i in range(len(self.weights))], [2 * w for w in self.weights], 2 * self.intercept)

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("p1", logistic(self.margin(as_array(df, self.features))))
        return scored.withColumn("prediction", (F.col("p1") > 0.5).cast("double"))


@dataclass
class ScoreLog:
    """A listener that keeps every ``every``th report."""

    every: int = 10
    rows: list[tuple[int, float]] = field(default_factory=list)
    layers: dict[int, SoftmaxLayer] = field(default_factory=dict)

    def __call__(self, step: int, loss: float, layer: SoftmaxLayer) -> None:
        if step % self.every == 0:
            self.rows.append((step, loss))
            self.layers[step] = layer

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "step int, loss double")


def log_loss(margin: Column, label: Column) -> Column:
    """-log of the label's probability, without overflow: log(1 + exp(-|m|)) + max(m, 0) - label * m."""
    return F.log1p(F.exp(-F.abs(margin))) + F.greatest(margin, F.lit(0.0)) - label * margin


def fit_softmax_epochs(
    df: DataFrame,
    batch: Column,
    batches: int,
    epochs: int = 10,
    rate: float = 0.1,
    momentum: float = 0.9,
    listener: Listener | None = None,
    features: str = "features",
    steps: int | None = None,
) -> SoftmaxLayer:
    """Stochastic gradient steps with Nesterov's momentum; ``batch`` (0 to ``batches`` - 1) says which mini-batch a row is in.

    The rows are written once, by mini-batch. A step reads the files of its own one, sums gradient and loss in one
    aggregate, and moves the weights: velocity v' = momentum v - rate g, weights + (1 + momentum) v' - momentum v. The
    listener hears every step's loss before its move. An epoch takes the mini-batches in order; one without rows is no
    step. ``steps`` ends the training early.
    """
    spark = df.sparkSession
    rows = df.select(F.col("label").cast("double").alias("label"), as_array(df, features).alias("x"), batch.cast("int").alias("batch"))
    path = fresh_path(spark, "mini-batches")
    salt = F.pmod(F.xxhash64("label", "x"), F.lit(FILES))
    rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), FILES), "batch", salt).write.partitionBy("batch").parquet(path)
    table = spark.read.schema("label double, x array<double>, batch int").parquet(path)
    head = table.select(F.size("x").alias("n")).first()
    if head is None:
        raise ValueError("there are no rows to fit")
    width = head.n
    weights, speed = [0.0] * (width + 1), [0.0] * (width + 1)
    step = 0
    for _ in range(epochs):
        for b in range(batches):
            if steps is not None and step >= steps:
                return SoftmaxLayer(tuple(weights[:-1]), weights[-1], features)
            layer = SoftmaxLayer(tuple(weights[:-1]), weights[-1], features)
            scored = table.where(F.col("batch") == b).select("label", "x", layer.margin(F.col("x")).alias("m"))
            miss = logistic(F.col("m")) - F.col("label")
            sums = [F.sum(miss * F.col("x")[i]) for i in range(width)] + [F.sum(miss)]
            found = scored.agg(F.count("*").alias("n"), F.sum(log_loss(F.col("m"), F.col("label"))).alias("loss"), *(s.alias(f"g{i}") for i, s in enumerate(sums))).first()
            if not found.n:
                continue
            if listener:
                listener(step, found.loss / found.n, layer)
            for i in range(width + 1):
                faster = momentum * speed[i] - rate * found[f"g{i}"] / found.n
                weights[i] += (1 + momentum) * faster - momentum * speed[i]
                speed[i] = faster
            step += 1
    return SoftmaxLayer(tuple(weights[:-1]), weights[-1], features)
