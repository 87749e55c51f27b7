"""Binned counts, ranks, trends and key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_counts(df: DataFrame, col: str, edges: list[float], include_lowest: bool = False) -> DataFrame:
    """bin, lo, hi, n for right-closed bins (lo, hi], empty ones too; values outside count nowhere."""
    x, at = F.col(col), F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        low = (x >= edges[i]) if include_lowest and i == 0 else (x > edges[i])
        at = F.when(low & (x <= edges[i + 1]), i).otherwise(at)
    counts = df.select(at.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    bins = df.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "bin int, lo double, hi double")
    return bins.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def equal_width_counts(df: DataFrame, col: str, n: int = 10, closed: str = "right", keys: tuple = ()) -> DataFrame:
    """bin (1..n), lo, hi, n for n bins of one width between smallest and largest value, by ``keys``.

    Right-closed bins have their lowest edge widened by 0.1 % of the range; left-closed ones close the last bin.
    """
    rows = df.where(F.col(col).isNotNull())
    bounds = rows.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    out = rows.join(bounds, list(keys)) if keys else rows.crossJoin(F.broadcast(bounds))
    width = (F.col("_hi") - F.col("_lo")) / n
    place = F.try_divide(F.col(col) - F.col("_lo"), width)
    bin_ = F.ceil(place) if closed == "right" else F.floor(place) + 1
    out = out.select(*keys, F.coalesce(F.least(F.lit(n), F.greatest(F.lit(1), bin_)), F.lit(1)).cast("int").alias("bin"))
    counts = out.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    bins = bounds.select(*keys, "_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("bin"))
    slack = (F.col("_hi") - F.col("_lo")) * 0.001 if closed == "right" else F.lit(0.0)
    return bins.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", F.round(F.col("_lo") + width * (F.col("bin") - 1) - F.when(F.col("bin") == 1, slack).otherwise(0.0), 6).alias("lo"),
        F.round(F.col("_lo") + width * F.col("bin"), 6).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def trend_impact(df: DataFrame, x: str, raw: str, adjusted: str) -> DataFrame:
    """Slope and intercept of both series over ``x`` and the change of slope in percent (infinite from a slope of 0)."""
    out = df.agg(F.regr_slope(raw, x).alias("raw_slope"), F.regr_intercept(raw, x).alias("raw_intercept"),
                 F.regr_slope(adjusted, x).alias("adj_slope"), F.regr_intercept(adjusted, x).alias("adj_intercept"))
    change = F.when(F.col("raw_slope") == 0, F.lit(float("inf"))).otherwise(
        (F.col("adj_slope") - F.col("raw_slope")) / F.abs("raw_slope") * 100)
    return out.withColumn("change_pct", change)


def exact_quantiles(df: DataFrame, col: str, qs: list[float], keys: tuple = (), buckets: int = 256) -> DataFrame:
    """keys, q, value: exact quantiles, linearly interpolated, of every group, as one lazy plan that scans ``df`` twice.

    The first scan gives each group approximate bounds of ``buckets`` ranges; they only balance the work. The second counts
    the different values by group and range; ranges are placed by their counts and each ranks its values, so no task
    holds more than one range. Exact copies of a value are one row before the shuffle.

    Missing values count nowhere; a group without values has none. A group with a NaN has NaN quantiles, as NumPy's.
    Infinities are values like others; between two values of which one is infinite the result is what arithmetic gives
    (NaN between both infinities), a rank that needs no interpolation is the value itself. Null keys are a group.
    """
    x = F.col("_x")
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(col).cast("double").alias("_x"))
    rows = rows.withColumn("_x", F.when(x == 0, F.lit(0.0)).otherwise(x))  # one zero
    names = [f"_k{i}" for i in range(len(keys))]
    steps = max(1, (buckets - 1).bit_length())
    n_bounds = 2**steps - 1
    shares = F.array(*[F.lit((i + 1) / (n_bounds + 1)) for i in range(n_bounds)])
    nan = F.isnan(x)
    bounds = rows.groupBy(*names).agg(
        F.percentile_approx(F.when(~nan, x), shares, F.lit(8 * (n_bounds + 1))).alias("_b"), F.count(F.when(~nan, x)).alias("_n"), F.max(F.coalesce(nan, F.lit(False))).alias("_nan"))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in names] or F.lit(True)
    # values above a bound lie beyond it: the number of bounds below a value by halving steps
    found = F.aggregate(F.array(*[F.lit(2**s) for s in reversed(range(steps))]), F.lit(0),
                        lambda at, s: F.when(x > F.get("_b", at + s - 1), at + s).otherwise(at))
    # both uses of the bounds, and both of the values, ask for the same columns, so Spark makes each shuffle once
    placed = rows.where(x.isNotNull() & ~nan).alias("r").join(bounds.where(~F.col("_nan")).alias("b"), same("r", "b")).select(*[F.col(f"r.{k}").alias(k) for k in names], "_x", "_n", found.alias("_at"))
    values = placed.groupBy(*names, "_at", "_x").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    # at most ``buckets`` rows a group
    totals = values.groupBy(*names, "_at").agg(F.sum("_c").alias("_t"), F.max("_n").alias("_m")).withColumn(
        "_below", F.coalesce(F.sum("_t").over(Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    in_range = Window.partitionBy(*names, "_at").orderBy("_x")
    values = values.withColumn("_up", F.sum("_c").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = values.alias("v").join(totals.alias("t"), [*([] if not names else same("v", "t")), F.col("v._at") == F.col("t._at"), F.col("v._n") == F.col("t._m")]).select(
        *[F.col(f"v.{k}").alias(k) for k in names], "_x", "_n", (F.col("_below") + F.col("_up") - F.col("_c")).alias("_first"), (F.col("_below") + F.col("_up") - 1).alias("_last"))
    # the rows that hold a wanted rank: the one at or below it and the one above
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")
    hits = ranked.select("*", wanted).withColumn("_rank", F.col("q") * (F.col("_n") - 1))
    low, high = F.floor("_rank"), F.least(F.floor("_rank") + 1, F.col("_n") - 1)
    hits = hits.where(((F.col("_first") <= low) & (low <= F.col("_last"))) | ((F.col("_first") <= high) & (high <= F.col("_last"))))
    ends = hits.groupBy(*names, "q").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.max(F.col("_rank") - low).alias("_part"))
    value = F.when((F.col("_part") == 0) | (F.col("_lo") == F.col("_hi")), F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part"))
    groups = bounds.select(*names, "_nan", ((F.col("_n") > 0) & F.col("_b").isNotNull()).alias("_any"), wanted)
    out = groups.alias("g").join(ends.alias("e"), [*([] if not names else same("g", "e")), F.col("g.q") == F.col("e.q")], "left")
    return out.select(*[F.col(f"g.{k}").alias(c) for k, c in zip(names, keys)], F.col("g.q").alias("q"), F.when(F.col("_nan"), F.lit(float("nan"))).when(F.col("_any"), value).alias("value"))


def exact_quantile(df: DataFrame, col: str, q: float, buckets: int = 256) -> DataFrame:
    """One row: the quantile ``q`` of all values, see ``exact_quantiles``."""
    return exact_quantiles(df, col, [q], (), buckets).select(F.col("value").alias("q"))


def percentile_scaled(df: DataFrame, col: str, alias: str, q: float = 0.99, cap: float = 0.35) -> DataFrame:
    """Scores over their quantile times ``cap``, held in [0, cap], rounded half to even at 2 digits."""
    from panelkit.functions.scalars import clip, half_even

    top = exact_quantile(df, col, q)
    return df.crossJoin(F.broadcast(top)).withColumn(
        alias, half_even(clip(F.try_divide(F.col(col), F.col("q")) * cap, 0.0, cap), 2)).drop("q")


def rank_rows(df: DataFrame, by: list[Column], k: int = 25, fade: int = 5) -> DataFrame:
    """The first ``k`` rows with their position and whether it is among the first ``fade``."""
    top = df.orderBy(*by).limit(k)
    return top.withColumn("rk", F.row_number().over(Window.orderBy(*by))).withColumn("strong", F.col("rk") <= fade)


def extremes(df: DataFrame, col: str, k: int, ties: list[str]) -> DataFrame:
    """The ``k`` smallest and the ``k`` largest rows, marked."""
    low = df.orderBy(F.col(col), *ties).limit(k).withColumn("side", F.lit("low"))
    return low.union(df.orderBy(F.col(col).desc(), *ties).limit(k).withColumn("side", F.lit("high")))


def kpi(df: DataFrame, price: str, points: str) -> DataFrame:
    out = df.agg(F.sum(price).alias("price"), F.sum(points).alias("points"))
    return out.withColumn("points_per_price", F.try_divide("points", "price"))


def formation(df: DataFrame, keys: tuple = ()) -> DataFrame:
    """Counts of defenders, midfielders and forwards as text, like 3-5-2."""
    n = lambda r: F.count_if(F.col("position") == r).cast("string")
    return df.groupBy(*keys).agg(F.concat_ws("-", n("DEF"), n("MID"), n("FWD")).alias("formation"))


def pivot_metric(results: DataFrame, row: str, col: str, values: list, metric: str) -> DataFrame:
    return results.groupBy(row).pivot(col, values).agg(F.round(F.avg(metric), 6))


def best_model(results: DataFrame, col: str, metric: str) -> DataFrame:
    means = results.groupBy(col).agg(F.avg(metric).alias("m"))
    return means.agg(F.min_by(col, F.struct("m", col)).alias("best"), F.min("m").alias("value"))
