"""Run a registered query and its SQL twin and compare all values."""

import math
from pathlib import Path

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(directory).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def sql_rows(con, text):
    cursor = con.execute(text)
    names = [column[0] for column in cursor.description]
    return names, [dict(zip(names, row)) for row in cursor.fetchall()]


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def canonical(names, rows):
    return sorted(tuple(normal(row[n]) for n in sorted(names)) for row in rows)


# How the comparison expects Spark types to show in DuckDB.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


def type_differences(df, con, text):
    theirs = {name: str(kind) for name, kind, *_ in con.execute("DESCRIBE " + text).fetchall()}
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    return {n: (ours[n], theirs.get(n)) for n in ours if ours[n] != theirs.get(n)}


def compare(spark, con, directory, run, text):
    """None when equal, else a short description of the difference."""
    df = run(spark, directory)
    ours = canonical(df.columns, [row.asDict() for row in df.collect()])
    names, rows = sql_rows(con, text)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = canonical(names, rows)
    if ours == theirs:
        return None
    left, right = set(ours), set(theirs)
    return (f"rows {len(ours)} / {len(theirs)}; only spark {len(left - right)} {sorted(left - right)[:3]}; "
            f"only sql {len(right - left)} {sorted(right - left)[:3]}")
