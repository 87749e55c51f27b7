"""Merging metric tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.clean import fill_defaults


def merge_metrics(tables: list[DataFrame], keys: list[str], defaults: dict) -> DataFrame:
    """All keys of all tables with all metrics; missing metrics get their default.

    Missing keys match each other. A spine of distinct keys keeps its partitioning through the left joins.
    """
    spine = reduce(DataFrame.union, [t.select(*keys) for t in tables]).distinct()
    out = spine
    for i, t in enumerate(tables):
        right = t.withColumnsRenamed({k: f"_{i}_{k}" for k in keys})
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{i}_{k}")) for k in keys])
        out = out.join(right, on, "left").drop(*[f"_{i}_{k}" for k in keys])
    return fill_defaults(out, defaults)


def attach_metric(left: DataFrame, right: DataFrame, col: str, on: list[str], default=None, single: bool = False) -> DataFrame:
    """Left join of one column; repeated keys fan out unless ``single`` keeps the largest value."""
    r = right.select(*on, col)
    if single:
        r = r.groupBy(*on).agg(F.max(col).alias(col))
    out = left.join(r, on, "left")
    return out if default is None else out.withColumn(col, F.coalesce(col, F.lit(default)))


def tag_odds(odds: DataFrame, fixtures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(odds with the period of their kickoff, one row with the number without one); the last fixture of a kickoff wins."""
    by_time = fixtures.groupBy("kickoff").agg(F.max_by("GW", "seq").alias("GW"))
    return odds.join(by_time, "kickoff"), odds.join(by_time, "kickoff", "left_anti").agg(F.count("*").alias("unmatched"))


def missing_periods(df: DataFrame, lo: int, hi: int, period: str = "GW") -> DataFrame:
    wanted = df.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias(period))
    return wanted.join(df.select(F.col(period).cast("int").alias(period)).distinct(), period, "left_anti")


def append_missing(base: DataFrame, new: DataFrame, period: str = "GW") -> DataFrame:
    """``base`` and those rows of ``new`` whose period it lacks, with all columns of both."""
    have = base.select(period).distinct()
    return base.unionByName(new.join(have, period, "left_anti"), allowMissingColumns=True)
