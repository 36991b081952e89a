"""Conditions that fail the job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, condition, message: str) -> DataFrame:
    """Pass rows through, failing the job on the first one that breaks the condition."""
    passes = F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return df.filter(passes)
