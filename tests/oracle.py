"""Run a query on Spark and its SQL on DuckDB; report the first difference."""

from __future__ import annotations

import duckdb

from tidemill.tables import SCHEMAS

# fixed values: matching type names
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(root: str):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for name in SCHEMAS:
        db.execute(f"create view {name} as select * from '{root}/{name}.parquet'")
    return db


def type_name(simple: str) -> str:
    if simple.startswith("array<"):
        return type_name(simple[6:-1]) + "[]"
    return TYPES.get(simple, simple)


def canonical(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def difference(spark, db, q, root) -> str | None:
    got = q(spark, root)
    got_types = {f.name: type_name(f.dataType.simpleString()) for f in got.schema.fields}
    got_rows = rows_of(got.columns, got.collect())
    want = db.execute(q.oracle)
    columns = [d[0] for d in want.description]
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_rows = rows_of(columns, want.fetchall())
    if not want_rows:
        return "the SQL gives no rows"
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    if got_types != want_types:
        wrong = {k: (got_types[k], want_types[k]) for k in got_types if got_types[k] != want_types[k]}
        return f"types (Spark, SQL): {wrong}"
    if len(got_rows) != len(want_rows):
        extra = sorted(set(got_rows) - set(want_rows))[:3]
        lack = sorted(set(want_rows) - set(got_rows))[:3]
        return f"{len(got_rows)} rows, want {len(want_rows)}; extra {extra}; missing {lack}"
    for a, b in zip(got_rows, want_rows):
        if a != b:
            return f"{a} != {b}"
    return None
