"""Run queries against DuckDB on the same tables: ``python tests/oracle.py [sf] [query …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(_plain(row[i]) for i in order) for row in rows))


def compare(spark, connection, folder, query, sql):
    result = query(spark, folder)
    ours = normalised(result.columns, [tuple(r) for r in result.collect()])
    expected = connection.execute(sql)
    theirs = normalised([c[0] for c in expected.description], expected.fetchall())
    assert ours[0] == theirs[0], (ours[0], theirs[0])
    assert len(ours[1]) == len(theirs[1]), (len(ours[1]), len(theirs[1]))
    differing = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    assert not differing, (len(differing), differing[:3])
    return len(ours[1])


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import new_session

    scale, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{scale}"
    spark, connection = new_session(), duck(folder)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                rows = compare(spark, connection, folder, query, sqls[name])
                verdict = "equal"
            else:
                rows, verdict = query(spark, folder).count(), "rows only"
            print(f"{name:26} {verdict:10} {rows:8} rows {time.time() - start:6.2f} s", flush=True)
        except Exception as error:
            print(f"{name:26} FAILED {str(error)[:1500]}", flush=True)
