"""Keyed binary-classifier training and scoring on Spark DataFrames and streams."""

__version__ = "0.1.0"
