"""Arbitrary per-record functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame


def map_records(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """A record map that expressions cannot say: ``fn`` turns batches (pandas) into batches."""
    return df.mapInPandas(fn, schema)


def filter_records(df: DataFrame, predicate: Column) -> DataFrame:
    """A record predicate, kept as an expression so that it can reach the scan."""
    return df.filter(predicate)
