"""Order-free comparison of a Spark result with a DuckDB result."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def spark_rows(df):
    return sorted(df.columns), normalized(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [entry[0] for entry in result.description]
    return sorted(columns), normalized(columns, result.fetchall())
