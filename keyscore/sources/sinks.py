"""Batch sinks: messages, feature text, evaluation reports and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.linalg import VectorUDT

from keyscore.functions.scalar import fmt
from keyscore.records import Layout


def to_messages(df: DataFrame, topic: str) -> DataFrame:
    """topic, key, value rows; the topic sink reads the topic column."""
    return df.select(
        F.lit(topic).alias("topic"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None, show: bool = True) -> DataFrame:
    """The first ``n`` rows and the schema, printed; any ``n`` rows where no order is given."""
    rows = df.orderBy(*order_by).limit(n) if order_by else df.limit(n)
    if show:
        df.printSchema()
        rows.show(n, truncate=False)
    return rows


def _feature_text(layout: Layout, numbered: bool = False) -> Column:
    """Feature slots as an array of texts: sensors with three decimals, indicators as 0 or 1; ``numbered`` puts ``i:`` before.

    One function over the array, as an expression for each slot makes a method too large to be compiled. A decimal has the
    same digits as the format, which costs many times as much; what a decimal lacks (a sign of zero, NaN, no number) is
    left to the format.
    """
    kinds = F.array(*[F.lit(kind == "q") for _, _, kind in layout.slots()])

    def text(sensor: Column, i: Column) -> Column:
        x = F.col("_slots")[i]
        plain = ((x == 0) & (x.cast("string") != "-0.0")) | F.abs(x).between(0.001, 1e14)
        number = F.when(plain, x.cast("decimal(18,3)").cast("string")).otherwise(fmt(x))
        shown = F.when(sensor, number).otherwise(x.cast("int").cast("string"))
        return F.concat(i.cast("string"), F.lit(":"), shown) if numbered else shown

    return F.transform(kinds, text)


def _with_slots(df: DataFrame, features: str) -> DataFrame:
    vector = isinstance(df.schema[features].dataType, VectorUDT)
    return df.withColumn("_slots", vector_to_array(F.col(features)) if vector else F.col(features))


def to_svmlight(df: DataFrame, layout: Layout, features: str = "features", label: str = "label") -> DataFrame:
    """``label 0:v 1:v ...`` lines, 0-based, with a trailing blank."""
    line = F.concat(F.concat_ws(" ", F.col(label).cast("string"), _feature_text(layout, numbered=True)), F.lit(" "))
    return _with_slots(df, features).select(line.alias("line"))


def write_svmlight(df: DataFrame, layout: Layout, path: str, features: str = "features", label: str = "label") -> str:
    to_svmlight(df, layout, features, label).write.mode("overwrite").text(path)
    return path


def to_feature_csv(df: DataFrame, layout: Layout, features: str = "features", label: str = "label") -> DataFrame:
    """Feature values, then the label, separated by ``, ``."""
    line = F.concat_ws(", ", _feature_text(layout), F.col(label).cast("string"))
    return _with_slots(df, features).select(line.alias("line"))


def write_feature_csv(df: DataFrame, layout: Layout, path: str, features: str = "features", label: str = "label") -> str:
    to_feature_csv(df, layout, features, label).write.mode("overwrite").text(path)
    return path


def write_train_test(
    df: DataFrame, order_by: Sequence[str], layout: Layout, path: str, n: int = 5, features: str = "features", label: str = "label"
) -> dict[tuple[str, str], str]:
    """Feature files of one ordered split: every ``n``th row is test, the others train, each as svmlight and as CSV.

    Rows are numbered once; one pass over them writes all four folders. Returns their paths by (format, part).
    """
    from keyscore.operators.features import split_nth

    slots = _with_slots(df, features).select(*order_by, F.col("_slots"), F.col(label).alias("_label"))
    numbered = split_nth(slots, order_by, n)
    svm = F.concat(F.concat_ws(" ", F.col("_label").cast("string"), _feature_text(layout, numbered=True)), F.lit(" "))
    csv = F.concat_ws(", ", _feature_text(layout), F.col("_label").cast("string"))
    lines = F.array(F.struct(F.lit("svm").alias("format"), svm.alias("line")), F.struct(F.lit("csv").alias("format"), csv.alias("line")))
    rows = numbered.select(F.when(F.col("is_test"), "test").otherwise("train").alias("part"), F.inline(lines))
    rows.write.mode("overwrite").partitionBy("format", "part").text(path)
    return {(f, p): f"{path}/format={f}/part={p}" for f in ("svm", "csv") for p in ("train", "test")}


def write_report(metrics: DataFrame, path: str) -> str:
    """Evaluation rows (stream, model, metric, value), added to what the report holds of other streams and models.

    What it held of the same stream and model is replaced, so a run that is repeated does not double its rows.
    """
    parts = metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "model")
    parts.json(path)
    return path


REPORT_SCHEMA = "stream string, model string, metric string, value double"
