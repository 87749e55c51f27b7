"""Projections and filters on panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Texts to doubles; what is no number becomes missing."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def period_slice(df: DataFrame, lo: int, hi: int, period: str = "GW") -> DataFrame:
    return df.where(F.col(period).between(lo, hi))


def next_period(fixtures: DataFrame, as_of: Column) -> DataFrame:
    """One row: the last period with a kickoff up to ``as_of`` and the one after it."""
    last = fixtures.where(F.col("kickoff") <= as_of).agg(F.max("GW").alias("last_period"))
    return last.withColumn("next_period", F.col("last_period") + 1)


def eligible(df: DataFrame, positions: list[str], min_minutes: float) -> DataFrame:
    return df.where(F.col("position").isin(positions) & (F.col("minutes") >= min_minutes))


def active_only(df: DataFrame, min_minutes: float = 30) -> DataFrame:
    """Rows with a known opponent and enough mean minutes; rolled minutes fall back to plain ones."""
    used = F.coalesce("roll3_minutes", "minutes") if "roll3_minutes" in df.columns else F.col("minutes")
    return df.where((F.col("opponent") != "Unknown") & (used >= min_minutes))


def one_hot(df: DataFrame, col: str, flags: dict[str, str]) -> DataFrame:
    """0/1 flags of a column's values; all 0 where it is missing or absent."""
    value = F.col(col) if col in df.columns else F.lit(None).cast("string")
    return df.withColumns({f: F.coalesce((value == v).cast("int"), F.lit(0)) for f, v in flags.items()})


ROLE_CODES = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}


def map_codes(col: Column, mapping: dict = ROLE_CODES) -> Column:
    out = F.lit(None).cast("string")
    for k, v in mapping.items():
        out = F.when(col == k, v).otherwise(out)
    return out


def lookup_name(df: DataFrame, dim: DataFrame, key: str, alias: str, default: str = "Unknown") -> DataFrame:
    names = dim.select(F.col("id").alias("_id"), F.col("name").alias("_name"))
    return df.join(names, F.col(key) == F.col("_id"), "left").withColumn(alias, F.coalesce("_name", F.lit(default))).drop("_id", "_name")


def available(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add absent columns and fill missing values."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()})


def first_present(df: DataFrame, alternatives: list[str], default) -> Column:
    """The first of the columns that exists and has a value, else the default."""
    return F.coalesce(*[F.col(c) for c in available(df, alternatives)], F.lit(default))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def filter_members(df: DataFrame, col: str, values: list | None) -> DataFrame:
    return df if values is None else df.where(F.col(col).isin(values))


def harmonise(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def with_period(df: DataFrame, gw: int) -> DataFrame:
    return df.withColumn("GW", F.lit(gw))


def columns_like(df: DataFrame, prefix: str | None = None) -> list[str]:
    """Columns by prefix, or all numeric ones."""
    if prefix is not None:
        return [c for c in df.columns if c.startswith(prefix)]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def impute_means(df: DataFrame, cols: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """Fill missing values with the column means of ``fitted`` (default: of ``df``), a one-row table."""
    means = (fitted if fitted is not None else df).agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(means))
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}")) for c in cols}).drop(*means.columns)
