"""Registered queries and their DuckDB SQL.

A query has a function (spark, sf_dir) -> DataFrame, the columns of its result with their kinds, and mostly the body of
an SQL that computes the same rows from the same tables by plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.plans import views


@dataclass(frozen=True)
class Query:
    ops: str
    run: object
    columns: tuple[tuple[str, str], ...]
    sql: str | None


REGISTRY: dict[str, Query] = {}
_SPARK_KIND = {
    "int": lambda c: F.col(f"`{c}`").cast("bigint"), "num": lambda c: F.round(F.col(f"`{c}`").cast("double"), 9) + 0.0,
    "near": lambda c: F.round(F.col(f"`{c}`").cast("double"), 6) + 0.0,
    "text": lambda c: F.col(f"`{c}`").cast("string"), "flag": lambda c: F.col(f"`{c}`").cast("int").cast("bigint"),
    "time": lambda c: F.date_format(F.col(f"`{c}`"), "yyyy-MM-dd HH:mm:ss")}
_SQL_KIND = {
    "int": 'CAST("{c}" AS BIGINT)', "num": 'round(CAST("{c}" AS DOUBLE), 9) + 0.0', "near": 'round(CAST("{c}" AS DOUBLE), 6) + 0.0',
    "text": 'CAST("{c}" AS VARCHAR)',
    "flag": 'CAST(CAST("{c}" AS INT) AS BIGINT)', "time": "strftime(\"{c}\", '%Y-%m-%d %H:%M:%S')"}


def query(ops: str, columns: str, sql: str | None = None):
    """Register the decorated function; ``columns`` is like "name team:text n:int x:num" (text if no kind is given; near: 6 digits)."""
    spec = tuple((c.partition(":")[0], c.partition(":")[2] or "text") for c in columns.split())

    def add(f):
        REGISTRY[f.__name__] = Query(ops, f, spec, sql)
        return f

    return add


def _typed(q: Query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.run(spark, sf_dir).select(*[_SPARK_KIND[k](c).alias(c) for c, k in q.columns])

    return run


def _load() -> None:
    from panelkit.plans import q_features, q_ingest, q_learning, q_models, q_reports, q_squads  # noqa: F401


def queries() -> dict:
    _load()
    return {n: _typed(q) for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    out = {}
    for n, q in REGISTRY.items():
        if q.sql:
            cols = ", ".join(_SQL_KIND[k].format(c=c) + f' AS "{c}"' for c, k in q.columns)
            steps = q.sql if q.sql.lstrip().startswith("WITH") else f"WITH r AS ({q.sql})"  # the last step is r
            out[n] = f"{views.CTES}, {steps.strip()[4:]} SELECT {cols} FROM r"
    return out
