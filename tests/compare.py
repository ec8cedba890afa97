"""Compare registered queries with their reference SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _shown(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    return str(value)


_KINDS = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def differences(spark, connection, query, sql, sf) -> list[str]:
    """What differs between a query and its SQL, as readable lines."""
    result = query(spark, sf)
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    problems = []
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    for field in result.schema.fields:
        kind = field.dataType.simpleString()
        if _KINDS.get(kind) != types[field.name]:
            problems.append(f"type of {field.name}: {kind} instead of {types[field.name]}")
    order = sorted(names)
    ours = sorted(tuple(_shown(row[c]) for c in order) for row in result.collect())
    places = [names.index(c) for c in order]
    theirs = sorted(tuple(_shown(row[i]) for i in places) for row in expected.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows instead of {len(theirs)}")
    mine, other = set(ours) - set(theirs), set(theirs) - set(ours)
    if mine or other:
        problems.append(f"{len(mine)} rows differ; columns {order}")
        for row in sorted(mine)[:2]:
            problems.append(f"  has  {row}")
        for row in sorted(other)[:2]:
            problems.append(f"  want {row}")
    return problems
