"""Order-insensitive comparison of a Spark result with SQL run by DuckDB."""

import glob
import os

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def differences(spark_df, connection, sql):
    """Empty when names, types and rows agree; a short description otherwise."""
    expected = connection.sql(sql).arrow()
    expected = expected.read_all() if hasattr(expected, "read_all") else expected
    actual = spark_df.toArrow()
    names = sorted(actual.column_names)
    if names != sorted(expected.column_names):
        return f"columns {names} != {sorted(expected.column_names)}"
    types = [(n, str(actual.schema.field(n).type).replace("large_", ""),
              str(expected.schema.field(n).type).replace("large_", "")) for n in names]
    wrong = [t for t in types if t[1] != t[2] and "null" not in t[2]]
    if wrong:
        return f"types {wrong}"
    if actual.num_rows != expected.num_rows:
        return f"rows {actual.num_rows} != {expected.num_rows}"
    left, right = (sorted(zip(*[t[n].to_pylist() for n in names]), key=repr)
                   for t in (actual, expected))
    pairs = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    return f"{len(pairs)} rows differ, first {pairs[0]}" if pairs else ""
