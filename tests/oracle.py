"""Side-by-side check of a registered query and its SQL twin.

Run as a script: ``python tests/oracle.py FOLDER [QUERY ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = """
region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations
""".split()

KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def compare(spark, con, query, sql, folder) -> str:
    """Empty text when equal, else what differs."""
    frame = query(spark, folder)
    names = sorted(frame.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in frame.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = dict(zip(columns, [str(d[1]) for d in result.description]))
    if sorted(columns) != names:
        return f"columns: only spark {set(names) - set(columns)}, only sql {set(columns) - set(names)}"
    order = [columns.index(n) for n in names]
    other = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    kinds_differ = {
        n: (k, kinds[n]) for n, k in frame.dtypes if KINDS.get(k, k).upper() != kinds[n].upper()
    }
    left, right = Counter(rows), Counter(other)
    if left != right:
        a, b = list((left - right).items())[:2], list((right - left).items())[:2]
        return f"rows {len(rows)} vs {len(other)}; columns {names}; only spark {a}; only sql {b}"
    if kinds_differ:
        return f"types: {kinds_differ}"
    return "" if rows else "both sides are empty"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from labtide.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    session = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            told = compare(session, connection, query, oracles[name], folder) if name in oracles else "no SQL"
        except Exception as error:  # noqa: BLE001
            told = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if not told else 'FAIL'} {name} {time.time() - start:.1f}s {told[:1500]}", flush=True)
    session.stop()
