"""Conditional update of rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_where(df: DataFrame, cond: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; rows where it is false or NULL stay. Right-hand sides see the old row."""
    return df.withColumns({c: F.when(cond, value).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, value in changes.items()})
