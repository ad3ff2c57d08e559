"""Projections over endpoint records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyscore.records import ColumnPlan


def flatten(df: DataFrame, structs: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The fields of the given structs as columns, after the columns to ``keep``."""
    return df.select(*keep, *[f"{name}.*" for name in structs])


def map_columns(df: DataFrame, col: str, prefix: str, n: int) -> DataFrame:
    """Entries ``prefix0 .. prefix(n-1)`` of a map as columns; a missing entry is null."""
    return df.select("*", *[F.try_element_at(F.col(col), F.lit(f"{prefix}{i}")).alias(f"{prefix}{i}") for i in range(n)])


def to_feature_table(df: DataFrame, plan: ColumnPlan) -> DataFrame:
    """Drop what the feature stages consumed and call the result column ``label``."""
    return df.drop(*plan.dropped).withColumnRenamed("Result", "label")


def expand(df: DataFrame, col: str, n: int, prefix: str = "f", digits: int | None = None) -> DataFrame:
    """The first ``n`` entries of an array column as columns ``prefix0, prefix1, ...``."""
    slots = [F.col(col)[i] for i in range(n)]
    if digits is not None:
        slots = [F.round(s, digits) for s in slots]
    return df.select(
        *[c for c in df.columns if c != col], *[s.alias(f"{prefix}{i}") for i, s in enumerate(slots)]
    )
