"""Spark results against DuckDB SQL on the same Parquet tables."""

import datetime
import os

import duckdb
import pandas as pd


def _plain(v):
    if isinstance(v, (list, tuple)):
        return str(list(v))
    if pd.isna(v):
        return None
    if isinstance(v, (pd.Timestamp, datetime.datetime)) and v == v.normalize():
        return str(v.date())
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v.item() if hasattr(v, "item") else v


def rows_of(frame: pd.DataFrame) -> list[str]:
    columns = sorted(frame.columns)
    return sorted(str([_plain(v) for v in row]) for row in frame[columns].itertuples(index=False, name=None))


def oracle(sql: str, sf: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{t}')")
    return con.execute(sql).df()


def assert_same(df, sql: str, sf: str) -> None:
    ours, theirs = df.toPandas(), oracle(sql, sf)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)
