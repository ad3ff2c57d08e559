"""Aggregates and evaluation. Each returns a small DataFrame; inputs carry ``label`` and ``prediction``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.functions.trees import FlatTrees, saved_trees, walk
from keyscore.storage import forget, fresh_path, materialize


def group_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("count"))


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample standard deviation, min and max, in one pass."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("stddev"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*aggs).alias("stats")).select(F.inline("stats"))


def confusion(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")).agg(
        F.count("*").alias("count")
    )


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def prf(df: DataFrame, positive: int = 1) -> DataFrame:
    """Precision, recall and F1 of one class; null where undefined."""
    said, real = F.col("prediction") == positive, F.col("label") == positive
    tp, fp, fn = (F.count_if(c).cast("double") for c in (said & real, said & ~real, ~said & real))
    return (
        df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
        .select(
            F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
            F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
        )
        .withColumn(
            "f1",
            F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
    )


def auc_hard(df: DataFrame) -> DataFrame:
    """Area under the ROC curve of the 0/1 prediction: (TPR + TNR) / 2, in one aggregate."""
    p = F.col("prediction").cast("double")
    tpr = F.avg(F.when(F.col("label") == 1, p))
    tnr = F.avg(F.when(F.col("label") == 0, 1 - p))
    return df.agg(((tpr + tnr) / 2).alias("auc"))


def auc_score_value(df: DataFrame, score: str = "score") -> float:
    """Exact area under the ROC curve of a score. Rows with equal scores are counted together
    before the range-partitioned sort, so a score that many rows share is one row of it."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="_score", labelCol="_label", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(
        df.select(F.col(score).cast("double").alias("_score"), F.col("label").cast("double").alias("_label"))
    )


def auc_score(df: DataFrame, score: str = "score") -> DataFrame:
    return df.sparkSession.createDataFrame([(auc_score_value(df, score),)], "auc double")


def flat_trees(model, classes: bool = False, step: float = 1.0) -> FlatTrees:
    """The trees of a fitted ensemble as flat arrays, from the table of nodes that it saves.

    Of a forest (``classes``) the output is the mean share of class 1 over its trees; of boosted trees, or of a boosted
    forest, whose ``step`` weighs each round, the margin after each round.
    """
    parts = [stage for stage in model.stages if hasattr(stage, "trees")] if hasattr(model, "stages") else [model]
    spark, trees, weights, rounds = SparkSession.active(), [], [], []
    for part in parts:
        path = fresh_path(spark, "trees")
        part.write().overwrite().save(path)
        found = saved_trees(spark.read.parquet(f"{path}/data"), classes)
        boosted = not classes and len(parts) == 1
        rounds += range(len(trees), len(trees) + len(found)) if boosted else [len(trees)]
        trees += found
        weights += list(part.treeWeights) if boosted else [step / len(found)] * len(found)
    return FlatTrees.of(trees, weights, rounds)


def margins_by_round(df: DataFrame, model, step: float = 1.0, features: str = "features") -> DataFrame:
    """Margin after each boosting round, as the array ``margins``: all trees in one pass over the rows."""
    return df.withColumn("margins", walk(vector_to_array(features), flat_trees(model, step=step)))


def forest_votes(df: DataFrame, model, features: str = "features") -> DataFrame:
    """Mean class-1 share of a forest's trees as ``vote``: all trees in one pass over the rows."""
    return df.withColumn("vote", walk(vector_to_array(features), flat_trees(model, classes=True))[0])


def auc_of_margins(scored: DataFrame, rounds: int, digits: int | None = None) -> DataFrame:
    """AUC of each entry of ``margins``, rounded to ``digits`` if given, with rows of equal margins counted together."""
    rows = []
    for i in range(rounds):
        margin = F.col("margins")[i] if digits is None else F.round(F.col("margins")[i], digits)
        rows.append((i, auc_score_value(scored.select("label", margin.alias("score")))))
    return scored.sparkSession.createDataFrame(rows, "round int, auc double")


def auc_by_round(df: DataFrame, model, step: float = 1.0, features: str = "features") -> DataFrame:
    """AUC of the scores after each boosting round; the rows are scored once, and their margins kept for all rounds."""
    flat = flat_trees(model, step=step)
    scored = materialize(df.select("label", walk(vector_to_array(features), flat).alias("margins")), "margins")
    out = auc_of_margins(scored, len(flat.rounds))
    forget(scored)
    return out


def loss_history(model, df: DataFrame) -> DataFrame:
    """Objective by iteration: of the fit for linear models, of ``df`` for boosted trees."""
    if hasattr(model, "evaluateEachIteration"):
        losses = model.evaluateEachIteration(df)
    else:
        losses = model.summary.objectiveHistory
    return df.sparkSession.createDataFrame(
        [(i, float(v)) for i, v in enumerate(losses)], "iteration int, loss double"
    )


def silhouette(df: DataFrame, features: str = "features") -> DataFrame:
    """Mean silhouette, squared euclidean, from per-cluster sums; no pairs of rows are formed."""
    value = ClusteringEvaluator(featuresCol=features).evaluate(df)
    return df.sparkSession.createDataFrame([(value,)], "silhouette double")


def centers(spark, model) -> DataFrame:
    """cluster, slot, value of every cluster centre."""
    rows = [(c, s, float(v)) for c, center in enumerate(model.clusterCenters()) for s, v in enumerate(center)]
    return spark.createDataFrame(rows, "cluster int, slot int, value double")


def importances(spark, model_path: str, names: DataFrame | None = None) -> DataFrame:
    """Split count, mean gain and mean cover of each feature, from the nodes of a saved tree ensemble.

    Cover is the mean number of training rows at the split. ``names`` (slot, name, type) adds the
    feature's name. The path may name several ensembles (``.../stages/*Forest*`` of a boosted forest).
    """
    nodes = spark.read.parquet(f"{model_path}/data")
    node = "nodeData" if "nodeData" in nodes.columns else None
    flat = nodes.select(f"{node}.*") if node else nodes
    splits = flat.filter(F.col("split.featureIndex") >= 0)
    table = splits.groupBy(F.col("split.featureIndex").alias("slot")).agg(
        F.count("*").alias("splits"), F.avg("gain").alias("gain"), F.avg("rawCount").alias("cover")
    )
    return table if names is None else names.join(F.broadcast(table), "slot")


def report_rows(df: DataFrame, stream: str | Column, model: str) -> DataFrame:
    """Standard metrics as report rows (stream, model, metric, value), in one pass.

    ``stream`` is a name, or the column that holds it where the rows are of several streams.
    """
    stream = F.lit(stream) if isinstance(stream, str) else stream
    p, y = F.col("prediction").cast("double"), F.col("label").cast("double")
    metrics = df.groupBy(stream.alias("stream")).agg(
        F.avg((p == y).cast("double")).alias("accuracy"),
        ((F.avg(F.when(y == 1, p)) + F.avg(F.when(y == 0, 1 - p))) / 2).alias("auc"),
        F.count("*").cast("double").alias("rows"),
    )
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "auc", "rows")]
    return metrics.select("stream", F.lit(model).alias("model"), F.inline(F.array(*pairs)))
