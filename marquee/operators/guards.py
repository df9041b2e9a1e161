"""Checks on the columns a step needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"input has no column {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def with_default(df: DataFrame, name: str, default) -> DataFrame:
    """Add the column `name` unless it is there already."""
    if name in df.columns:
        return df
    return df.withColumn(name, default if isinstance(default, Column) else F.lit(default))
