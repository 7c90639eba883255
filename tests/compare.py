"""A query's rows against those of its SQL in DuckDB, whatever their order."""

import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def database(folder=SF):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    return con


def rows(frame):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>", "nan"):
            return "null"
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return f"{round(float(v), 6) + 0.0:.6f}"
        return str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False))


def assert_same(spark_frame, sql_frame):
    assert sorted(spark_frame.columns) == sorted(sql_frame.columns)
    assert rows(spark_frame) == rows(sql_frame)
