"""Landing files: CSV folders with one header line into all-text tables, JSON lines into one VARIANT column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.clean import NULL_TOKENS, token_to_null
from tiffin.schemas import raw_schema

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "true"}

# Tables with a free-text column, whose quoted fields may hold line breaks. Their files are read whole, not in splits.
FREE_TEXT = frozenset({"customer_feedback"})


def csv_reader(reader, table: str, mode: str, rejects: str | None, multi_line: bool | None):
    """A reader, batch or streaming, set up for the landing files of a table."""
    whole = table in FREE_TEXT if multi_line is None else multi_line
    schema = raw_schema(table)
    if rejects is not None:
        schema = schema.add(rejects, "string")
        reader = reader.option("columnNameOfCorruptRecord", rejects)
    return reader.options(**CSV_OPTIONS, mode=mode, multiLine=str(whole).lower()).schema(schema)


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Blank, NULL and null read as NULL in every text column."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[token_to_null(c, tokens) if c in text else F.col(c) for c in df.columns])


def parse_events(lines: DataFrame) -> DataFrame:
    """One VARIANT per JSON line; a line that is no JSON becomes NULL."""
    return lines.select(F.try_parse_json("value").alias("event_raw"))


def read_raw_csv(
    spark: SparkSession,
    path: str,
    table: str,
    *,
    mode: str = "PERMISSIVE",
    rejects: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """A folder of CSV files. Lines with too few or too many fields are kept as far as they go.

    ``mode`` FAILFAST refuses them and DROPMALFORMED leaves them out; ``rejects`` names a column that holds their text.
    ``multi_line`` lets quoted fields hold line breaks; by default it is on for tables with free text only, as such files are
    not split.
    """
    return null_tokens(csv_reader(spark.read, table, mode, rejects, multi_line).csv(path))


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_events(spark.read.text(path))
