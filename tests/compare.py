"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df, con, sql):
    """None when names, types and all values are equal, else a short description."""
    ours_types = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    ours_columns, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    theirs_columns, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours_columns != theirs_columns:
        return f"columns {ours_columns} != {theirs_columns}"
    if ours_types != theirs_types:
        return f"types {sorted(ours_types.items() ^ theirs_types.items())}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
