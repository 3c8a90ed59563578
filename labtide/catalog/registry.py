"""Registration of a query function together with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labtide.catalog.sql_tables import TABLES
from labtide.standins import Standins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The module each query is registered in.
MODULES: dict[str, str] = {}


def _with_tables(sql: str, tables: tuple[str, ...]) -> str:
    """Put the SQL definitions of ``tables`` in front; the text may go on with common table expressions of its own."""
    body = sql.strip()
    if not tables:
        return body
    defined = ",\n".join(f"{t} AS (\n{TABLES[t].strip()}\n)" for t in tables)
    if body.upper().startswith("WITH "):
        return f"WITH {defined},\n{body[5:]}"
    if body.startswith(","):
        return f"WITH {defined}{body}"
    return f"WITH {defined}\n{body}"


def query(sql: str | None = None, *tables: str):
    """Register a function of the stand-in tables under its own name.

    ``tables`` names the SQL definitions that the text of ``sql`` reads.
    """

    def register(build: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
        name = build.__name__
        MODULES[name] = build.__module__.rpartition(".")[2]
        QUERIES[name] = lambda spark, sf_dir: build(Standins(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = _with_tables(sql, tables)
        return build

    return register
