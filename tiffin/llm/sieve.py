"""The sieve with the size that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiffin.functions import sieve

WORDS = sieve.WORDS


def sieved(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return sieve.sieved(df, key, keys, WORDS)
