"""Run a registered query and its SQL over one folder and compare the rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

# Spark type -> the DuckDB type of the same column.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when they agree."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    problems = []
    if sorted(relation.columns) != names:
        return [f"columns {names} != {sorted(relation.columns)}"]
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} vs {kinds[name]}")
    mine = sorted(map(repr, (tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())))
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(map(repr, relation.select(quoted).fetchall()))
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows vs {len(theirs)}")
    elif mine != theirs:
        first = next((a, b) for a, b in zip(mine, theirs) if a != b)
        problems.append(f"values differ, first: {first}")
    if not mine:
        problems.append("no rows")
    return problems
