"""Compare registered queries with their DuckDB statements, value by value.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from checks.oracle import oracle_sql
from checks.registry import queries

DUCK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def _sorted(rows: list[tuple], order: list[int]) -> list[tuple]:
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is not None, 0 if v is None else v) for v in r))


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> str | None:
    """None when names, types and all values agree; otherwise what differs first."""
    result = con.execute(oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in result.description}
    theirs = result.fetchall()
    kinds = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    # The client library reports numbers without their width in some versions.
    named = {c: (k, types.get(c)) for c, k in kinds.items() if types.get(c) not in (k, "NUMBER")}
    if named or kinds.keys() != types.keys():
        return f"columns {named or kinds.keys() ^ types.keys()}"
    columns = sorted(kinds)
    a = _sorted([tuple(r) for r in df.collect()], [df.columns.index(c) for c in columns])
    b = _sorted(theirs, [list(types).index(c) for c in columns])
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{dict(zip(columns, x, strict=True))} against {dict(zip(columns, y, strict=True))}"
    return None


def main() -> int:
    from tiffin.session import session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.perf_counter()
        found = difference(queries()[name](spark, sf_dir), con, name)
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.perf_counter() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
