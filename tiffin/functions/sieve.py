"""Which rows of a large table may have a key of another one, told without moving the large table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits that are sent to the tasks at most: about 6 MB.
WORDS = 1 << 18


def sieved(df: DataFrame, key: str, keys: DataFrame, most: int = WORDS) -> DataFrame:
    """Adds ``_may``: false for rows whose key is certainly none of ``keys`` (a single column), true for all that have one and a few others.

    Every key sets one bit by its hash, and a row looks its own bit up. So rows of no interest need no shuffle, and the exact join is left
    with the others. What is sent to the tasks is bounded however many keys there are: more keys only let more rows through. Null keys
    are none. ``keys`` is read for every use of the result, so it should be stored. ``most`` is the number of words of 64 bits.
    """
    (name,) = keys.columns
    kind = keys.schema[name].dataType
    words = _placed(keys.filter(F.col(name).isNotNull()), F.col(name), most).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    rows = _placed(df, F.col(key).cast(kind), most).join(F.broadcast(words), "_word", "left")
    met = F.col(key).isNotNull() & (F.getbit("_bits", F.col("_bit")) == 1)
    return rows.withColumn("_may", F.coalesce(met, F.lit(False))).drop("_word", "_bit", "_bits")


def _placed(df: DataFrame, key: Column, most: int) -> DataFrame:
    place = F.pmod(F.xxhash64(key), F.lit(64 * most))
    return df.withColumns({"_word": F.shiftright(place, 6), "_bit": (place % 64).cast("int")})
