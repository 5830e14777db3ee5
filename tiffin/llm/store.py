"""Intermediate tables in the folder that the cluster's machines share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tiffin.session import shared_folder


def new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """The rows written as Parquet and read back: the lineage ends there, so a lost executor costs only what read it last.

    ``small`` is for rows much smaller than what they were made from: they are gathered into files of the advisory size, where each task
    would else write a tiny file.
    """
    path = new_folder(df.sparkSession, name)
    (df.hint("rebalance") if small else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bounded_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Meanwhile Python gets rows in Arrow batches of about ``size`` bytes, or of one row; afterwards the session's own limit holds again.

    Spark's limit of 64 MB lets a batch be a whole task's input, which the JVM holds outside its heap and Python once more. The bound holds for
    what is run meanwhile, as by ``stored``.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def bounded_broadcasts(spark: SparkSession, size: int) -> Iterator[None]:
    """Meanwhile Spark broadcasts no table above ``size`` bytes by its own choice, or by the session's limit if that is lower; afterwards that one
    holds again.

    Spark's limit is for files, which are packed; the driver holds what it broadcasts as rows, as a hash table and in pieces to send. A chain of
    many joins, as of the rounds of ``components``, fills its heap with that long before the limit looks large.
    """
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {name: spark.conf.get(name, None) for name in names}
    for name, held in before.items():
        if held is not None:
            spark.conf.set(name, str(min(size, _bytes(spark, held))))
    try:
        yield
    finally:
        for name, held in before.items():
            if held is not None:
                spark.conf.set(name, held)


def _bytes(spark: SparkSession, text: str) -> int:
    """A size as settings write it: 10485760, 10485760b, 10m, or -1 for none."""
    return -1 if text.strip().startswith("-") else int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))
