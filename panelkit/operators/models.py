"""Splits, distributed models on MLlib, metrics and back-tests."""

from __future__ import annotations

from contextlib import contextmanager
from itertools import product
from threading import Condition
from typing import NamedTuple

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.scalars import hash_unit
from panelkit.operators import trees
from panelkit.operators.clean import available
from panelkit.shared import discard, in_threads, saved, spread

# Fixed by the models: feature lists.
FEATURES = {
    "goals": ["minutes", "xP", "threat", "transfers_in", "expected_goals", "creativity", "ict_index", "starts", "is_forward", "is_midfielder",
              "is_defender", "is_goalkeeper", "team_attacking", "opp_defending", "fixture_difficulty"],
    "assists": ["roll3_minutes", "roll3_creativity", "expected_assists", "ict_index", "influence", "transfers_in", "team_attacking",
                "opp_defending", "fixture_difficulty", "is_forward", "is_midfielder", "is_defender"],
    "cards": ["roll3_minutes", "roll3_yellow_cards", "roll3_red_cards", "team_attacking", "opp_defending", "fixture_difficulty", "was_home",
              "is_defender", "is_midfielder", "is_forward"],
    "bonus": ["roll3_minutes", "roll3_goals_scored", "roll3_assists", "roll3_clean_sheets", "roll3_saves", "roll3_yellow_cards",
              "roll3_red_cards", "roll3_threat", "roll3_creativity", "roll3_influence", "roll3_ict_index", "team_attacking", "opp_defending",
              "fixture_difficulty", "is_forward", "is_midfielder", "is_defender", "is_goalkeeper"],
    "clean_sheets": ["roll3_minutes", "team_def_z", "opp_att_z", "fixture_diff_z", "team_cs_avg", "opp_cs_allow", "team_xgc_z"],
    "backtest": ["minutes", "xP", "threat", "creativity"],
    "comparison": ["minutes", "threat", "creativity", "ict_index", "starts"],
}
# Fixed by the models: columns that the comparison adds where they exist.
COMPARISON_OPTIONAL = ["xP", "expected_goals", "expected_goal_involvements"]


def feature_list(df: DataFrame, wanted: list[str], optional: dict[str, str] | None = None) -> list[str]:
    """The wanted features that exist, and optional ones whose column exists."""
    return available(df, wanted) + [c for c in (optional or {}).values() if c in df.columns]


def feature_vector(df: DataFrame, features: list[str]) -> DataFrame:
    ready = df.withColumns({c: F.col(c).cast("double") for c in features})
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error").transform(ready)


def split(df: DataFrame, keys: list[str], share: float = 0.8, seed: int = 42) -> Column:
    """True for training rows: a hash of the keys, so the split does not depend on partitions."""
    return hash_unit(*[F.col(k) for k in keys], seed=seed) < share


def stratified(df: DataFrame, label: str, keys: list[str], share: float = 0.75, seed: int = 42) -> DataFrame:
    """``df`` with ``train``: true for exactly round(share * n) of the n rows of each stratum, halves up.

    A stratum's rows are drawn by a hash of the keys (60 bits of md5), ties by the keys. Where the last drawn row lies is
    found by counting hashes in 2^15 ranges and then in 2^15 ranges of the range that holds it, so no task sees a
    whole stratum; only the few rows of that last range are sorted. Rows without a label are a stratum; rows that agree in
    all keys are interchangeable. Columns named like the steps' (``_h`` and so on) or ``train`` are replaced.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    rows = df.drop("train").withColumns({"_h": h, "_l": F.col(label)}).withColumns({
        "_a": F.shiftright("_h", 45), "_b": F.shiftright("_h", 30).bitwiseAND(F.lit(32767))})
    wanted = F.floor(F.col("_n") * share + 0.5)

    def place(counts: DataFrame, at: str) -> DataFrame:
        """The range in which a stratum's last training row lies, and how many rows are wanted of it."""
        upto = F.sum("_c").over(Window.partitionBy("_l").orderBy(at).rowsBetween(Window.unboundedPreceding, 0))
        found = counts.withColumn("_upto", upto).where((F.col("_upto") - F.col("_c") < F.col("_want")) & (F.col("_want") <= F.col("_upto")))
        return found.select(F.col("_l").alias("_ll"), F.col(at).alias(f"_cut{at}"), (F.col("_want") - F.col("_upto") + F.col("_c")).alias(f"_of{at}"))

    counts = rows.groupBy("_l", "_a").agg(F.count("*").alias("_c"))
    counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy("_l"))).withColumn("_want", wanted)
    first = place(counts, "_a")
    inner = rows.join(first, F.col("_l").eqNullSafe(F.col("_ll")) & (F.col("_a") == F.col("_cut_a"))).groupBy("_l", "_b").agg(
        F.count("*").alias("_c"), F.max("_of_a").alias("_want"))
    cuts = first.join(place(inner, "_b").withColumnRenamed("_ll", "_l2"), F.col("_ll").eqNullSafe(F.col("_l2"))).drop("_l2")
    # strata of which no row is wanted have no cut
    marked = rows.join(cuts, F.col("_l").eqNullSafe(F.col("_ll")), "left")
    edge = F.coalesce((F.col("_a") == F.col("_cut_a")) & (F.col("_b") == F.col("_cut_b")), F.lit(False))
    below = F.coalesce((F.col("_a") < F.col("_cut_a")) | ((F.col("_a") == F.col("_cut_a")) & (F.col("_b") < F.col("_cut_b"))), F.lit(False))
    last = F.row_number().over(Window.partitionBy("_l").orderBy("_h", *keys)) <= F.col("_of_b")
    out = marked.where(~edge).withColumn("train", below).unionByName(marked.where(edge).withColumn("train", last))
    return out.select(*[c for c in df.columns if c != "train"], "train")


def forest_regressor(trees=200, leaf=5, depth=8, features="sqrt", seed=42, label="label"):
    """Random forest. The models' sizes: goals 200 trees and leaf 5, assists 300 and 10, bonus 300 and 5, clean sheets 500 and 30 with all features."""
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(numTrees=trees, minInstancesPerNode=leaf, maxDepth=depth, featureSubsetStrategy=features, seed=seed, labelCol=label, cacheNodeIds=True)


def forest_classifier(trees=400, leaf=20, depth=8, seed=42, label="label"):
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(numTrees=trees, minInstancesPerNode=leaf, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, labelCol=label, weightCol="weight",
                                  cacheNodeIds=True)  # no descent from the root for each row, tree and level


def boosted_regressor(rounds=100, rate=0.1, depth=3, sample=1.0, columns=1.0, seed=42, label="label"):
    """Gradient boosting. The back-test's size: 300 rounds of rate 0.05 and depth 4 with shares of 0.8 of rows and columns."""
    from pyspark.ml.regression import GBTRegressor

    return GBTRegressor(maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=sample, featureSubsetStrategy="all" if columns >= 1 else str(columns),
                        seed=seed, labelCol=label)


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """weight = rows / (classes * rows of the class). Rows stay in their tasks: shuffled by label they would lie in as many tasks as there are classes."""
    per = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = per.agg(F.sum("_n").alias("_all"), F.count("*").alias("_k"))
    return df.join(F.broadcast(per), label).crossJoin(F.broadcast(total)).withColumn(
        "weight", F.col("_all") / (F.col("_k") * F.col("_n"))).drop("_n", "_all", "_k")


def positive_probability(scored: DataFrame) -> Column:
    return vector_to_array(scored["probability"])[1]


class Calibration(NamedTuple):
    """1 / (1 + exp(-(slope * score + intercept)))"""

    slope: float
    intercept: float

    @property
    def coefficients(self) -> list[float]:
        return [self.slope]

    def probability(self, score: Column) -> Column:
        return 1 / (1 + F.exp(-(score * self.slope + self.intercept)))


def _newton(a: float, b: float, sums: tuple) -> tuple[float, float, float]:
    """The next (slope, intercept), and the length of the step."""
    ga, gb, haa, hab, hbb = sums
    ga, haa = ga + a, haa + 1.0  # the penalty of half the squared slope
    det = haa * hbb - hab * hab
    if not det > 0:
        return a, b, 0.0
    da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
    step = max(abs(da), abs(db))
    shrink = min(1.0, 5.0 / step) if step else 1.0
    return a - shrink * da, b - shrink * db, step


def platt(held_out: DataFrame, score: str, label: str = "label", buckets: int = 4096, tolerance: float = 1e-10) -> Calibration:
    """Logistic regression on one score with a penalty of half the squared slope, by Newton steps on sums.

    Steps first run on a histogram of scores (counts, score and label sums of ``buckets`` buckets), which is small; from
    there a few exact steps follow, each one aggregate over the scores. Missing, NaN and infinite scores and missing labels count nowhere;
    without rows slope and intercept are 0. With labels of one kind the intercept runs off and steps end at their limit.
    """
    x = F.col("_s")
    rows = held_out.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y"))
    rows = saved(rows.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & F.col("_y").isNotNull()), "scores")
    low, high = rows.agg(F.min("_s"), F.max("_s")).first()
    if low is None:
        return Calibration(0.0, 0.0)
    at = F.least(F.floor((x - low) / max(high - low, 1e-300) * buckets), F.lit(buckets - 1))
    seen = rows.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.avg("_s").alias("s"), F.sum("_y").alias("y")).collect()  # at most ``buckets`` rows
    s, n, y = (np.array([r[c] for r in seen], float) for c in ("s", "n", "y"))
    a = b = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -500, 500)))
        v = n * p * (1 - p)
        a, b, step = _newton(a, b, (float(((n * p - y) * s).sum()), float((n * p - y).sum()), float((v * s * s).sum()), float((v * s).sum()), float(v.sum())))
        if step < 1e-9:
            break
    for _ in range(20):
        p = 1 / (1 + F.exp(-(x * a + b)))
        v = p * (1 - p)
        g = rows.agg(F.sum((p - F.col("_y")) * x), F.sum(p - F.col("_y")), F.sum(v * x * x), F.sum(v * x), F.sum(v)).first()
        a, b, step = _newton(a, b, tuple(map(float, g)))
        if step < tolerance:
            break
    return Calibration(a, b)


def importance_table(model, features: list[str], spark) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def ridge_one(df: DataFrame, x: str, y: str, alpha: float = 0.0, keys: tuple = ()) -> DataFrame:
    """Slope and intercept of a regression on one feature with an L2 penalty on the slope."""
    stats = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(
        F.regr_sxx(y, x).alias("_xx"), F.regr_sxy(y, x).alias("_xy"), F.avg(x).alias("_x"), F.avg(y).alias("_y"))
    slope = F.try_divide(F.col("_xy"), F.col("_xx") + alpha)
    return stats.select(*keys, slope.alias("slope"), (F.col("_y") - slope * F.col("_x")).alias("intercept"))


def error_metrics(df: DataFrame, y: str, p: str, keys: tuple = ()) -> DataFrame:
    e, ok = F.col(y) - F.col(p), F.col(y).isNotNull() & F.col(p).isNotNull()
    return df.where(ok).groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count("*"))).alias("r2"), F.count("*").alias("n"))


def brier(df: DataFrame, y: str, p: str, keys: tuple = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"), F.count("*").alias("n"))


def backtest_means(df: DataFrame, targets: list[str], cutoffs: list[int], windows: list[int], group: str | None = "position") -> DataFrame:
    """Rolling-origin back-test of the group mean (or the plain mean): one scan for the whole grid.

    Trains on GW <= cutoff, tests on the next ``window`` periods; cells without train or test rows are left out.
    """
    rows = df.select("GW", *([group] if group else []), F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in targets])).alias("t")).select(
        "GW", *([group] if group else []), "t.target", "t.y").where(F.col("y").isNotNull())
    grid = [F.struct(F.lit(c).alias("cutoff"), F.lit(w).alias("window")) for c, w in product(cutoffs, windows)]
    rows = rows.withColumn("g", F.explode(F.array(*grid))).select("*", "g.cutoff", "g.window").drop("g").where(F.col("GW") <= F.col("cutoff") + F.col("window"))
    keys = ["target", "cutoff", "window"]
    train = F.col("GW") <= F.col("cutoff")
    per = rows.groupBy(*keys, *([group] if group else [])).agg(
        F.count_if(train).alias("a_n"), F.avg(F.when(train, F.col("y"))).alias("mean"))
    test = rows.where(~train).join(per.select(*keys, *([group] if group else []), "mean"), [*keys, *([group] if group else [])]).where(F.col("mean").isNotNull())
    metrics = error_metrics(test, "y", "mean", tuple(keys)).withColumnRenamed("n", "n_test")
    n_train = per.groupBy(*keys).agg(F.sum("a_n").alias("n_train"))
    return metrics.join(n_train, keys).where("n_train > 0 and n_test > 0")


class Cell(NamedTuple):
    """A row of a grid's results: metrics, or why there are none."""

    model: str
    target: str
    cutoff: int
    window: int
    mae: float | None
    rmse: float | None
    r2: float | None
    n_train: int
    n_test: int
    error: str | None


CELLS = "model string, target string, cutoff int, window int, mae double, rmse double, r2 double, n_train bigint, n_test bigint, error string"


def feature_matrix(df: DataFrame, targets: list[str], features: list[str]) -> DataFrame:
    """Stored rows GW, the targets and the vector of features, each period in all files where there are many; rows that lack a feature are left out."""
    rows = df.select("GW", *[F.col(t).cast("double").alias(f"y_{t}") for t in targets], *[F.col(f).cast("double").alias(f"x_{f}") for f in features])
    rows = feature_vector(rows.dropna(subset=["GW", *[f"x_{f}" for f in features]]), [f"x_{f}" for f in features])
    matrix = saved(rows.select("GW", *[F.col(f"y_{t}").alias(t) for t in targets], "features"), "matrix")
    even = spread(matrix, 25000, 0.0)  # even files may still have one period each
    if even is matrix:
        return matrix
    out = saved(even, "matrix")
    discard(matrix)
    return out


class Room:
    """Lets callers in while what they need together is no more than ``size``; one that needs more goes in alone."""

    def __init__(self, size: float):
        self.size, self.taken, self.changed = size, 0.0, Condition()

    @contextmanager
    def take(self, need: float):
        need = min(need, self.size)
        with self.changed:
            self.changed.wait_for(lambda: self.taken + need <= self.size)
            self.taken += need
        try:
            yield
        finally:
            with self.changed:
                self.taken -= need
                self.changed.notify_all()


#: Bytes for each core that rows kept by fits side by side may take.
CORE_BYTES = 500e6


def _row_bytes(estimator) -> int:
    """About what MLlib keeps of a row during a fit: bins and residuals, for a forest a count and two sets of node ids for each tree."""
    return 250 + (12 * estimator.getNumTrees() if estimator.hasParam("numTrees") else 0)


def _fit_cell(matrix: DataFrame, name: str, estimator, model, target: str, cutoff: int, windows: list[int], counts: dict, room: Room) -> list[Cell]:
    """One fit on GW <= cutoff, unless there is a model, scored once for all windows; an exception in place of either is the cell's failure."""
    n_train, tests = counts[target, cutoff], {w: counts[target, cutoff, w] for w in windows}
    if not n_train or not any(tests.values()):
        return []
    try:
        for x in (estimator, model):
            if isinstance(x, Exception):
                raise x
        rows = matrix.where(F.col(target).isNotNull()).select("GW", "features", F.col(target).alias("label"))
        if model is None:
            with room.take(n_train * _row_bytes(estimator)):
                model = estimator.fit(rows.where(F.col("GW") <= cutoff))
        scored = model.transform(rows.where((F.col("GW") > cutoff) & (F.col("GW") <= cutoff + max(windows)))).select("GW", "label", "prediction")
        grid = F.explode(F.array(*map(F.lit, windows))).alias("window")
        found = error_metrics(scored.select("*", grid).where(F.col("GW") <= F.col("window") + cutoff), "label", "prediction", ("window",)).collect()
        return [Cell(name, target, cutoff, r["window"], r["mae"], r["rmse"], r["r2"], n_train, r["n"], None) for r in found]
    except Exception as e:  # a row of the result, not swallowed
        return [Cell(name, target, cutoff, w, None, None, None, n_train, n, f"{type(e).__name__}: {e}"[:200]) for w, n in tests.items() if n]


def run_grid(matrix: DataFrame, models: dict, targets: list[str], cutoffs: list[int], windows: list[int], side_by_side: int = 12) -> DataFrame:
    """Rolling-origin back-test of MLlib estimators: metrics of each model, target, cutoff and window, failures as rows with ``error``.

    ``matrix`` is stored once (``feature_matrix``); rows are counted for the whole grid in one scan. Forests and boosting over all features
    are grown together from binned rows (``trees``). Other fits run side by side, each
    distributed and in a pool of its own, so that the fair scheduler (``spark.scheduler.mode``) lets them share the
    cluster; with many rows fewer run at once, so that what MLlib keeps of them stays in memory. Cells without train or test rows are left out.
    """
    spark = matrix.sparkSession
    train = [((t, c), F.count_if((F.col("GW") <= c) & F.col(t).isNotNull())) for t in targets for c in cutoffs]
    test = [((t, c, w), F.count_if((F.col("GW") > c) & (F.col("GW") <= c + w) & F.col(t).isNotNull())) for t in targets for c in cutoffs for w in windows]
    found = matrix.agg(*[x.alias(str(i)) for i, (_, x) in enumerate(train + test)]).first()
    counts = {k: found[i] for i, (k, _) in enumerate(train + test)}
    jobs = list(product(models.items(), targets, cutoffs))
    room = Room(CORE_BYTES * spark.sparkContext.defaultParallelism)

    def made(make):
        try:
            return make()
        except Exception as e:  # a row of the result, not swallowed
            return e

    estimators = {(name, target, cutoff): made(make) for (name, make), target, cutoff in jobs}
    grown = trees.train(matrix, {(name, t, c): (e, t, c, counts[t, c]) for (name, t, c), e in estimators.items()
                                 if counts[t, c] and any(counts[t, c, w] for w in windows)})

    def work(job):
        (name, _), target, cutoff = job
        return _fit_cell(matrix, name, estimators[name, target, cutoff], grown.get((name, target, cutoff)), target, cutoff, windows, counts, room)

    cells = [c for out in in_threads(spark, work, jobs, side_by_side) for c in out]
    return spark.createDataFrame(cells, CELLS)


def model_grid(df: DataFrame, models: dict, targets: list[str], cutoffs: list[int], windows: list[int], features: list[str]) -> tuple[DataFrame | None, list]:
    """``run_grid`` over a panel: (results of the cells that worked or None, failures (model, target, cutoff, window, why))."""
    cells = run_grid(feature_matrix(df, targets, features), models, targets, cutoffs, windows)
    failed = [(r["model"], r["target"], r["cutoff"], r["window"], r["error"]) for r in cells.where("error IS NOT NULL").collect()]
    good = cells.where("error IS NULL").drop("error")
    return (None if good.isEmpty() else good), failed
