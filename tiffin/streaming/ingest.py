"""Continuous ingest: each file that lands is loaded once and appended to the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiffin.functions.clean import token_to_null
from tiffin.schemas import EVENTS, RAW_COLUMNS
from tiffin.sources.raw import csv_reader


def _landing(
    spark: SparkSession, path: str, table: str, max_files: int | None, mode: str, rejects: str | None, multi_line: bool | None
) -> DataFrame:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stamps = [F.col("_metadata.file_path").alias("_ingest_file"), F.current_timestamp().alias("_ingest_ts")]
    if table == EVENTS:
        return reader.text(path).select(F.try_parse_json("value").alias("event_raw"), *stamps)
    csv = csv_reader(reader, table, mode, rejects, multi_line).csv(path)
    kept = [] if rejects is None else [F.col(rejects)]
    return csv.select(*[token_to_null(c) for c in RAW_COLUMNS[table].split()], *kept, *stamps)


def ingest_stream(
    spark: SparkSession,
    path: str,
    table: str,
    out: str,
    checkpoint: str,
    *,
    interval: str | None = None,
    max_files: int | None = None,
    mode: str = "PERMISSIVE",
    rejects: str | None = None,
    multi_line: bool | None = None,
) -> StreamingQuery:
    """Start the ingest of one landing folder. Without an interval it loads what is there and stops.

    The checkpoint remembers the files, so a restart loads only new ones; the parquet sink commits each batch once. Rows are stamped
    with their file and the time of their batch. ``mode``, ``rejects`` and ``multi_line`` are those of the batch reader.
    """
    landing = _landing(spark, path, table, max_files, mode, rejects, multi_line)
    writer = landing.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(out)
