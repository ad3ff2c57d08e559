"""Column functions: JSON, text, scaling, rounding and small vector arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(df: DataFrame, schema: T.StructType, col: str = "value", alias: str = "data") -> DataFrame:
    """Replace JSON text by a typed record; malformed text gives a record of nulls.

    No option is passed: the default mode is the one meant, and an option would make Spark parse every field of the
    schema, also those that nothing reads.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != col]
    return df.select(*kept, F.from_json(F.col(col), schema).alias(alias))


def emit_json(df: DataFrame, cols: Sequence[str] | None = None, key: str = "key") -> DataFrame:
    """key, value rows whose value is the JSON text of ``cols`` (all columns by default)."""
    cols = list(cols or df.columns)
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def cast_kv(df: DataFrame, *extra: str) -> DataFrame:
    """Message bytes to string key and value, with any ``extra`` columns kept."""
    return df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", *extra)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once although ``body`` names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fmt(col: Column, digits: int = 3) -> Column:
    """Number as text with a fixed number of decimals."""
    return F.format_string(f"%.{digits}f", col.cast("double"))


def scale(col: Column, divisor: float) -> Column:
    return col / F.lit(float(divisor))


def round_label(probability: Column) -> Column:
    """Probability to 0/1, half rounds up."""
    return F.floor(probability + F.lit(0.5)).cast("int")


def argmax2(p0: Column, p1: Column) -> Column:
    """1 where the second class is strictly more probable."""
    return F.when(p1 > p0, 1).otherwise(0)


def feature_array(exprs: Sequence[Column]) -> Column:
    return F.array(*[e.cast("double") for e in exprs])


def weighted_sum(columns: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    """w . x + b, left to right, as one arithmetic expression."""
    if len(columns) != len(weights):
        raise ValueError("one weight per column is needed")
    terms = [c * F.lit(float(w)) for c, w in zip(columns, weights)]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0)) + F.lit(float(intercept))


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
