"""Compare registered queries with their SQL twins: ``python tests/oracle_check.py SF_DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sortable(row):
    return tuple((value is not None, str(type(value)), value) if value is not None else (False, "", "") for value in row)


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(_plain(row[c]) for c in columns) for row in df.collect()), key=_sortable)


def rows_of_sql(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_sortable)


def difference(spark, sf_dir: str, name: str) -> str | None:
    """None when both engines agree on columns and rows, else what differs first."""
    columns, mine = rows_of_spark(entry.queries()[name](spark, sf_dir))
    expected_columns, expected = rows_of_sql(sf_dir, entry.oracle_sql()[name])
    if columns != expected_columns:
        return f"columns {columns} / {expected_columns}"
    if len(mine) != len(expected):
        return f"{len(mine)} rows, expected {len(expected)}"
    for got, wanted in zip(mine, expected, strict=True):
        if got != wanted:
            cells = [(c, g, w) for c, g, w in zip(columns, got, wanted, strict=True) if g != w]
            return f"first difference {str(cells)[:600]} in {str(got)[:300]}"
    return None


if __name__ == "__main__":
    from postloom.session import build_session

    session = build_session("oracle_check", cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    for query in names:
        start = time.time()
        try:
            found = difference(session, folder, query)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {query} {time.time() - start:.1f}s {found or ''}", flush=True)
