"""Parquet tables with versions.

A full refresh writes a new data folder and publishes it by creating one small marker file, so a table is never
overwritten while it is read, a failed write leaves the old version in place, and earlier versions can be read back.

    <table>/data/<version>/...            parquet files of a version written in full
    <table>/data/<column>=<value>/_part=<version>/...  parquet files of one value, written by that version and kept by later ones
    <table>/published/<millis>.<version>  marker; the highest one not after the asked time is the version to read

The marker of a version written by ``replace_parts`` lists its schema and its folders, so a version that touches two months shares all other
months with the one before. One writer per table at a time is assumed: the refresh.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType


#: Of all tables: text and times, which most columns are, take about a third less room than by Spark's default.
CODEC = "zstd"


def _fs(spark: SparkSession, path: str):
    """Hadoop path and its file system, so that any store Spark can write to will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[0]):
        raise OSError(f"could not move {path} to {to}")


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(publish time in epoch milliseconds, version), oldest first."""
    marks = [name.split(".", 1) for name in list_names(spark, f"{path}/published") if name[0].isdigit()]
    return sorted((int(millis), version) for millis, version in marks)


@dataclass(frozen=True)
class Manifest:
    """The folders that make up a version: (value, folder) by the text of the column they are laid out by, None standing for NULL."""

    schema: StructType
    by: str
    parts: tuple[tuple[str | None, str], ...]

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "by": self.by, "parts": self.parts})

    @classmethod
    def parse(cls, text: str) -> Manifest | None:
        """None for a version written in full, whose marker is empty."""
        if not text:
            return None
        known = json.loads(text)
        return cls(StructType.fromJson(known["schema"]), known["by"], tuple((v, f) for v, f in known["parts"]))


def _marker(spark: SparkSession, path: str, millis: int, version: str):
    return _fs(spark, f"{path}/published/{millis:015d}.{version}")


def _read_marker(spark: SparkSession, path: str, millis: int, version: str) -> str:
    marker, fs = _marker(spark, path, millis, version)
    stream = fs.open(marker)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """What the current version is made of; None if there is no version, or if it was written in full."""
    known = versions(spark, path)
    return Manifest.parse(_read_marker(spark, path, *known[-1])) if known else None


def _publish(spark: SparkSession, path: str, version: str, at_millis: int | None, content: str = "") -> int:
    earlier = versions(spark, path)
    millis = int(time.time() * 1000) if at_millis is None else at_millis
    if earlier:
        millis = max(millis, earlier[-1][0] + 1)
    marker, fs = _marker(spark, path, millis, version)
    # Written beside its place and renamed: a marker is never seen half written.
    draft, _ = _fs(spark, f"{path}/published/_{version}.{millis}")
    stream = fs.create(draft, True)
    try:
        if content:
            stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(draft, marker):
        raise OSError(f"could not publish {marker}")
    return millis


def overwrite_table(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), at_millis: int | None = None, keep: int | None = None
) -> int:
    """Write a full new version and make it current. ``df`` may read the table itself. Returns the publish time.

    With ``keep``, only so many of the newest versions stay, the new one included.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{path}/data/{version}", compression=CODEC)
    millis = _publish(spark, path, version, at_millis)
    _open(spark, path, version, None, df.schema)
    if keep is not None:
        _expire(spark, path, max(1, keep))
    return millis


PART = "_part"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def replace_parts(
    df: DataFrame,
    path: str,
    by: str,
    *,
    replaced: Collection[str | None] | None,
    added: Collection[str | None] = (),
    hide: bool = False,
    at_millis: int | None = None,
    keep: int | None = None,
    more: Sequence[DataFrame] = (),
) -> int:
    """Write rows in folders by a column, and publish a version of these and of the current version's other folders. ``more`` rows of the same
    columns are written one after the other, and published with them.

    ``replaced`` names the values whose earlier folders go (all of them if None), ``added`` those whose folders stay beside the new ones; the
    rows must have no other values. Folders of values that are not named are neither read nor written. With ``hide``, the column serves the
    layout only and is no column of the table. A table that was last written in full has no such folders and can only be replaced as a whole.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    shown = StructType([f for f in df.schema.fields if not (hide and f.name == by)])
    earlier = manifest(spark, path)
    if earlier is None and replaced is not None and versions(spark, path):
        raise ValueError(f"{path} was written in full and has no folders by {by}")
    kept = [] if earlier is None or replaced is None else [p for p in earlier.parts if p[0] not in replaced]
    for rows in (df, *more):
        rows.withColumn(PART, F.lit(version)).write.mode("append").partitionBy(by, PART).parquet(f"{path}/data", compression=CODEC)
    values = set(added) | set(replaced) if replaced is not None else {_value(n) for n in list_names(spark, f"{path}/data") if n.startswith(f"{by}=")}
    folders = [(v, f"{by}={_NULL_FOLDER if v is None else v}/{PART}={version}") for v in sorted(values, key=lambda v: (v is not None, v or ""))]
    fresh = [(v, f) for v, f in folders if exists(spark, f"{path}/data/{f}")]
    made = Manifest(shown, by, tuple([*kept, *fresh]))
    millis = _publish(spark, path, version, at_millis, made.text())
    _open(spark, path, version, made)
    if keep is not None:
        _expire(spark, path, max(1, keep))
    return millis


def _value(folder: str) -> str | None:
    value = folder.split("=", 1)[1]
    return None if value == _NULL_FOLDER else value


def _folders(spark: SparkSession, path: str, millis: int, version: str) -> list[str]:
    made = Manifest.parse(_read_marker(spark, path, millis, version))
    return [version] if made is None else [folder for _, folder in made.parts]


def _expire(spark: SparkSession, path: str, keep: int) -> None:
    """Remove versions before the newest ones: the marker first, so that nobody opens what is about to go. Folders that a staying version
    shares stay."""
    known = versions(spark, path)
    staying = {folder for mark in known[-keep:] for folder in _folders(spark, path, *mark)}
    for millis, version in known[:-keep]:
        folders = _folders(spark, path, millis, version)
        marker, fs = _marker(spark, path, millis, version)
        fs.delete(marker, False)
        for folder in folders:
            if folder not in staying:
                fs.delete(_fs(spark, f"{path}/data/{folder}")[0], True)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a plain parquet folder."""
    df.write.mode("append").parquet(path, compression=CODEC)


def read_table(spark: SparkSession, path: str, as_of_millis: int | None = None, schema: str | None = None) -> DataFrame:
    """The current version, or the one that was current at a time. With a schema, a table never written reads as empty."""
    known = [mark for mark in versions(spark, path) if as_of_millis is None or mark[0] <= as_of_millis]
    if known:
        return _current(spark, path, *known[-1])
    if schema is None:
        raise FileNotFoundError(f"no version of {path} at {as_of_millis or 'any time'}")
    return empty(spark, schema)


def read_parts(spark: SparkSession, path: str, values: Collection[str | None]) -> DataFrame | None:
    """The rows of some values of a table written by ``replace_parts``, with the column of the layout. Only their folders are listed and
    read. None if there is no such version."""
    made = manifest(spark, path)
    if made is None:
        return None
    layout = [] if made.by in made.schema.names else [StructField(made.by, StringType())]
    schema = StructType([*made.schema.fields, *layout])
    return _parts(spark, path, schema, [f for v, f in made.parts if v in values])


def _parts(spark: SparkSession, path: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return empty(spark, schema)
    reader = spark.read.schema(StructType([*schema.fields, StructField(PART, StringType())])).option("basePath", f"{path}/data")
    return reader.parquet(*[f"{path}/data/{f}" for f in folders]).select(*schema.names)


_opened: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def _current(spark: SparkSession, path: str, millis: int, version: str) -> DataFrame:
    held = _opened.get((spark.sparkContext.applicationId, path))
    if held is not None and held[0] == version and held[1].sparkSession is spark:
        return held[1]
    return _open(spark, path, version, Manifest.parse(_read_marker(spark, path, millis, version)))


def _open(spark: SparkSession, path: str, version: str, made: Manifest | None, schema: StructType | None = None) -> DataFrame:
    """A version never changes, so the schema and file listing of the last one opened per table are kept."""
    if made is not None:
        df = _parts(spark, path, made.schema, [folder for _, folder in made.parts])
    else:
        df = (spark.read if schema is None else spark.read.schema(schema)).parquet(f"{path}/data/{version}")
    _opened[spark.sparkContext.applicationId, path] = (version, df)
    return df


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of rows. Handed over as Arrow they become a local relation, which needs no Python workers."""
    columns = StructType.fromDDL(schema)
    data = pa.table(
        {f.name: pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(columns.fields)}
    )
    return spark.createDataFrame(data, columns)


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """No rows. Written as a query, which the optimizer sees to be empty, unlike an empty RDD."""
    columns = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in columns.fields]
    return spark.range(1).select(*nulls).filter(F.lit(False))


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table with all its versions."""
    _opened.pop((spark.sparkContext.applicationId, path), None)
    remove_folder(spark, path)


def read_as_of(spark: SparkSession, path: str, as_of_millis: int) -> DataFrame:
    return read_table(spark, path, as_of_millis)


def restore_as_of(spark: SparkSession, path: str, as_of_millis: int, at_millis: int | None = None) -> int:
    """Make the version of an earlier time current again. Only a marker is written; no data is copied."""
    known = [mark for mark in versions(spark, path) if mark[0] <= as_of_millis]
    if not known:
        raise FileNotFoundError(f"no version of {path} at {as_of_millis}")
    return _publish(spark, path, known[-1][1], at_millis, _read_marker(spark, path, *known[-1]))


def advance_history(
    spark: SparkSession, path: str, schema: str, advance: Callable[[DataFrame], DataFrame], *, keep: int | None = None
) -> int:
    """Store the next state of a dimension with version history: current versions are rewritten, closed ones only ever added.

    ``advance`` gets the current versions and returns them as they are now, with those that it closed (``is_current`` false). Folders of
    versions closed by earlier runs are neither read nor written. A table written in full before is laid out anew once.
    """
    now = read_parts(spark, path, ["true"])
    if now is None:
        before = read_table(spark, path, schema=schema)
        rows = advance(before.filter("is_current")).unionByName(before.filter("not is_current"))
        return replace_parts(rows, path, "is_current", replaced=None, keep=keep)
    return replace_parts(advance(now), path, "is_current", replaced=["true"], added=["false"], keep=keep)


def upkeep_by_bucket(
    spark: SparkSession,
    path: str,
    schema: str,
    key: str,
    src: DataFrame,
    advance: Callable[[DataFrame], DataFrame],
    *,
    buckets: int = 64,
    keep: int | None = None,
) -> int:
    """Store the next state of a table whose rows change by their own key only: folders by a hash of the key, of which those that the keys of
    ``src`` fall in are read and written, the others shared with the version before.

    ``advance`` gets the rows of these folders and returns them as they are now. The number of folders is that of the first call. A table
    written in full before is laid out anew once.
    """
    made = manifest(spark, path)
    laid = made is not None and made.by.startswith(_KEY_BUCKET)
    by = made.by if laid else f"{_KEY_BUCKET}{buckets}"

    def bucket() -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(int(by.removeprefix(_KEY_BUCKET)))).cast("string")

    if not laid:
        before = read_table(spark, path, schema=schema)
        return replace_parts(advance(before).withColumn(by, bucket()), path, by, replaced=None, hide=True, keep=keep)
    touched = [r[0] for r in src.filter(F.col(key).isNotNull()).select(bucket()).distinct().collect()]
    rows = advance(read_parts(spark, path, touched).drop(by)).withColumn(by, bucket())
    return replace_parts(rows.hint("rebalance", by), path, by, replaced=touched, hide=True, keep=keep)


_KEY_BUCKET = "key_of_"
