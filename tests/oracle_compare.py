"""Compare registered queries with their SQL, run by an in-process DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

# Spark type -> DuckDB type of the same column
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(con: duckdb.DuckDBPyConnection, sql: str, result: DataFrame) -> list[str]:
    """What differs between a result and its SQL: schema, row count, values."""
    con.execute(sql)
    described = {d[0]: str(d[1]) for d in con.description}
    expected = con.fetchall()
    mine = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    if set(mine) != set(described):
        return [f"columns {sorted(set(mine) ^ set(described))}"]
    found = [
        f"type of {name}: {dtype} / {described[name]}"
        for name, dtype in mine.items()
        if SAME_TYPE.get(dtype) != described[name]
    ]
    names = sorted(mine)
    columns = [list(described).index(name) for name in names]
    theirs = Counter(tuple(row[i] for i in columns) for row in expected)
    ours = Counter(tuple(row) for row in result.select(*names).collect())
    if sum(ours.values()) != sum(theirs.values()):
        found.append(f"rows {sum(ours.values())} / {sum(theirs.values())}")
    only_ours, only_theirs = ours - theirs, theirs - ours
    if only_ours or only_theirs:
        found.append(
            f"{sum(only_ours.values())} rows differ in {names}: "
            f"{sorted(map(str, only_ours))[:2]} / {sorted(map(str, only_theirs))[:2]}"
        )
    return found
