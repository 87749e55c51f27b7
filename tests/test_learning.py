"""Regressions, strata, quantiles, calibration, ranges, grids and prepared features against plain NumPy."""

import io
import math
import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import features, models, prepare, regression, report, trees
from panelkit.plans import catalogue
from panelkit.shared import in_threads, spread

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def executed(df) -> str:
    """The plan as it ran, each shuffle once."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


# --- regression
def table(spark, r, n, p=4, offset=0.0):
    x = r.normal(size=(n, p)) * (np.arange(p) * 50 + 1) + offset
    y = x @ (np.arange(p) + 1.0) + 3 + r.normal(size=n)
    rows = [(int(i % 12), *map(float, v), float(t), None if i % 7 == 0 else float(t * 2)) for i, (v, t) in enumerate(zip(x, y))]
    names = [f"f{i}" for i in range(p)]
    return spark.createDataFrame(rows, "GW int, " + ", ".join(f"{c} double" for c in names) + ", a double, b double").repartition(5), x, y, names


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_regression_equals_plain_least_squares(spark, offset):
    df, x, y, names = table(spark, np.random.default_rng(1), 400, offset=offset)
    got = {(r["target"], r["cutoff"], r["alpha"]): r for r in regression.linear_cells(df, names, ["a", "b"], [3, 8], [0.0, 1.0]).collect()}
    assert len(got) == 8
    gw = np.arange(400) % 12
    for (target, cutoff, alpha), r in got.items():
        keep = (gw <= cutoff) & ((target == "a") | (np.arange(400) % 7 != 0))
        xs, ys = x[keep], y[keep] * (1 if target == "a" else 2)
        c = xs - xs.mean(0)
        w = np.linalg.solve(c.T @ c + alpha * np.eye(4), c.T @ (ys - ys.mean()))
        assert r["n"] == keep.sum() and np.allclose(r["weights"], w, rtol=1e-7, atol=1e-9)
        assert math.isclose(r["intercept"], ys.mean() - w @ xs.mean(0), rel_tol=1e-6, abs_tol=1e-6)


def test_regression_of_hard_rows(spark):
    rows = [(1, 1.0, 2.0, 3.0), (1, 2.0, 4.0, 5.0), (1, 3.0, 6.0, 7.0), (None, 1.0, 1.0, 1.0), (2, None, 1.0, 1.0), (2, 1.0, 1.0, None), (3, 5.0, 5.0, 9.0)]
    df = spark.createDataFrame(rows, "k int, u double, v double, y double")
    got = {r["k"]: r for r in regression.solve(regression.cross_products(df, ["u", "v"], "y", ("k",)), [0.0], ("k",)).collect()}
    # dependent features share the weight; one row has no slope; a null key is a cell; cells without whole rows are missing
    assert set(got) == {1, 3, None} and np.allclose(got[1]["weights"], [0.4, 0.8]) and math.isclose(got[1]["intercept"], 1.0)
    assert np.allclose(got[3]["weights"], 0) and got[3]["intercept"] == 9.0
    assert regression.solve(regression.cross_products(df.limit(0), ["u"], "y"), [1.0]).count() == 0


def test_backtest_of_linear_models(spark):
    df, x, y, names = table(spark, np.random.default_rng(2), 600)
    got = {(r["cutoff"], r["window"], r["alpha"]): r for r in regression.linear_backtest(df, names, ["a"], [5, 11], [1, 2], [0.0, 1.0]).collect()}
    assert set(got) == {(5, w, a) for w in (1, 2) for a in (0.0, 1.0)}  # nothing follows GW 11
    gw = np.arange(600) % 12
    train, test = gw <= 5, (gw > 5) & (gw <= 7)
    w = np.linalg.lstsq(np.c_[x[train], np.ones(train.sum())], y[train], rcond=None)[0]
    e = y[test] - np.c_[x[test], np.ones(test.sum())] @ w
    r = got[5, 2, 0.0]
    assert math.isclose(r["mae"], np.abs(e).mean(), rel_tol=1e-9) and math.isclose(r["r2"], 1 - (e**2).sum() / ((y[test] - y[test].mean()) ** 2).sum(), rel_tol=1e-9)
    assert (r["n_train"], r["n_test"]) == (train.sum(), test.sum())


# --- strata
@pytest.mark.parametrize("share", [0.75, 0.5, 0.0, 1.0])
def test_strata_have_their_exact_share(spark, share):
    sizes = {"a": 1, "b": 2, "c": 20, "d": 333, None: 7, "hot": 3000}
    rows = [(k, i, "x") for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "label string, id int, train string")
    got = models.stratified(df, "label", ["label", "id"], share)
    assert got.columns == ["label", "id", "train"] and got.count() == len(rows)
    n = {r["label"]: r["n"] for r in got.groupBy("label").agg(F.count_if("train").alias("n")).collect()}
    assert n == {k: math.floor(v * share + 0.5) for k, v in sizes.items()}
    again = models.stratified(df.repartition(7), "label", ["label", "id"], share)
    assert got.exceptAll(again).count() == 0


def test_strata_of_repeated_rows_and_none(spark):
    df = spark.createDataFrame([("a", 1)] * 40 + [("b", 2)] * 4, "label string, id int")
    got = {r["label"]: r["n"] for r in models.stratified(df, "label", ["id"]).groupBy("label").agg(F.count_if("train").alias("n")).collect()}
    assert got == {"a": 30, "b": 3}
    assert models.stratified(df.limit(0), "label", ["id"]).count() == 0


# --- quantiles
def test_quantiles_equal_numpy(spark):
    r = np.random.default_rng(3)
    qs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.99, 1.0]
    groups = {"normal": r.normal(size=997), "ties": r.integers(0, 3, 500).astype(float), "one": np.array([4.0]), "same": np.full(300, -2.5),
              None: r.normal(size=50) * 1e300, "zeros": np.array([0.0, -0.0, 0.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("normal", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    for buckets in (2, 7, 256):
        got = {(a["k"], a["q"]): a["value"] for a in report.exact_quantiles(df, "x", qs, ("k",), buckets).collect()}
        assert len(got) == 7 * len(qs)
        for k, vs in groups.items():
            for q in qs:
                assert np.isclose(got[k, q], np.quantile(vs, q), rtol=1e-12, atol=0), (k, q, buckets)
        assert all(got["none", q] is None for q in qs)


def test_quantiles_of_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    groups = {"nan": [1.0, nan, 2.0], "up": [1.0, 2.0, inf], "both": [-inf, inf], "down": [-inf, -inf, 5.0], "all": [inf] * 4}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, x double")
    got = {(a["k"], a["q"]): a["value"] for a in report.exact_quantiles(df, "x", [0.0, 0.5, 0.75, 1.0], ("k",)).collect()}
    assert all(math.isnan(got["nan", q]) for q in (0.0, 0.5, 1.0))
    assert (got["up", 0.0], got["up", 0.5], got["up", 0.75], got["up", 1.0]) == (1.0, 2.0, inf, inf)
    assert got["both", 0.0] == -inf and got["both", 1.0] == inf and math.isnan(got["both", 0.5])
    assert got["down", 0.5] == -inf and got["down", 1.0] == 5.0 and got["all", 0.75] == inf
    one = report.exact_quantile(spark.createDataFrame([(1.0,), (inf,), (3.0,)], "x double"), "x", 0.99).first()[0]
    assert one == inf


def test_quantiles_scan_twice(spark):
    text = executed(catalogue.queries()["quantiles_by_role"](spark, SF))
    assert text.count("FileScan parquet") == 2


# --- rolling means over ranges
def rolled(df, by):
    return sorted((tuple(r) for r in df.select("name", "GW", "seq", *by).collect()), key=str)


@pytest.mark.parametrize("n,shift,ranges", [(3, 0, 8), (3, 1, 8), (7, 2, 40), (1, 0, 4), (2, 0, 1)])
def test_ranges_give_the_same_rolling_means(spark, n, shift, ranges):
    r = random.Random(n + shift)
    rows = [("hot" if r.random() < 0.9 else f"p{r.randrange(40)}", r.randrange(30), i, None if r.random() < 0.1 else r.random(), i) for i in range(1500)]
    rows += [(None, 1, 9000, 2.0, 0)]
    df = spark.createDataFrame(rows, "name string, GW int, seq int, m double, k int").repartition(4)
    want = features.rolling_mean(df, ["m", "k"], n, min_periods=2, shift=shift)
    got = features.rolling_mean_ranged(df, ["m", "k"], n, min_periods=2, shift=shift, ranges=ranges)
    by = [f"roll{n}_m", f"roll{n}_k"]
    digits = lambda d: rolled(d.withColumns({c: F.round(c, 9) for c in by}), by)
    assert digits(got) == digits(want) and got.columns == want.columns
    text = plan_of(got)
    assert "hashpartitioning(name" not in text and "hashpartitioning(_range" in text


def test_ranges_of_few_rows(spark):
    df = spark.createDataFrame([("a", 1, 1, 5.0), ("a", 2, 2, 7.0), ("b", 1, 3, 1.0)], "name string, GW int, seq int, m double")
    for rows in (df, df.limit(0)):
        assert rolled(features.rolling_mean_ranged(rows, ["m"], ranges=50), ["roll3_m"]) == rolled(features.rolling_mean(rows, ["m"]), ["roll3_m"])


# --- calibration
def plain_platt(s, y):
    a = b = 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * s + b)))
        v = p * (1 - p)
        g = np.array([((p - y) * s).sum() + a, (p - y).sum()])
        h = np.array([[(v * s * s).sum() + 1, (v * s).sum()], [(v * s).sum(), v.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return a, b


@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (0.05, 0.2), (30.0, -100.0)])
def test_calibration_equals_numpy(spark, scale, shift):
    r = np.random.default_rng(5)
    z = r.normal(size=2000)
    s, y = z * scale + shift, (r.random(2000) < 1 / (1 + np.exp(-(1.5 * z - 1)))).astype(float)
    df = spark.createDataFrame(list(zip(s.tolist(), y.tolist())) + [(None, 1.0), (float("nan"), 0.0), (0.1, None), (float("inf"), 1.0)], "score double, label double")
    got = models.platt(df, "score")
    assert np.allclose([got.slope, got.intercept], plain_platt(s, y), rtol=1e-6, atol=1e-6)


def test_calibration_of_few_rows(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.5, 0.0)], "score double, label double")
    got = models.platt(df, "score")
    assert abs(got.slope) < 1e-9 and abs(got.intercept) < 1e-9
    assert tuple(models.platt(df.limit(0), "score")) == (0.0, 0.0)
    one = models.platt(spark.createDataFrame([(0.1, 1.0), (0.9, 1.0)], "score double, label double"), "score")
    assert math.isfinite(one.slope) and one.intercept > 0


# --- grids
def test_grid_reports_failures_as_rows(spark):
    df = spark.range(300).select((F.col("id") % 10).cast("int").alias("GW"), (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 * 2).cast("double").alias("y"))

    def bad():
        raise ValueError("no such model")

    grid = {"forest": lambda: models.forest_regressor(trees=5, features="all"), "bad": bad}
    got = models.run_grid(models.feature_matrix(df, ["y"], ["x"]), grid, ["y"], [5, 8, 9], [1, 2]).collect()
    good = {(r["cutoff"], r["window"]): r for r in got if r["model"] == "forest"}
    assert set(good) == {(5, 1), (5, 2), (8, 1), (8, 2)} and all(r["error"] is None and r["mae"] < 3 for r in good.values())
    assert (good[5, 2]["n_train"], good[5, 2]["n_test"], good[8, 2]["n_test"]) == (180, 60, 30)
    failed = [r for r in got if r["model"] == "bad"]
    assert len(failed) == 4 and all("no such model" in r["error"] and r["mae"] is None and r["n_train"] for r in failed)
    assert models.run_grid(models.feature_matrix(df.limit(0), ["y"], ["x"]), grid, ["y"], [5], [1]).count() == 0


def test_boosting_takes_shares_of_rows_and_columns():
    b = models.boosted_regressor(300, 0.05, 4, 0.8, 0.8)
    assert (b.getMaxIter(), b.getStepSize(), b.getMaxDepth(), b.getSubsamplingRate(), b.getFeatureSubsetStrategy()) == (300, 0.05, 4, 0.8, "0.8")


def test_forests_beat_the_mean(spark):
    """The registered models, on all dimensions: errors against a constant guess."""
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("label").cast("double").alias("y"))
    test = e.withColumn("train", models.split(None, ["vec_id"])).where("NOT train")
    guess = test.agg(F.stddev_pop("y").alias("rmse"), F.avg((F.col("y") == 3).cast("double")).alias("p")).first()
    got = catalogue.queries()["rf_reg"](spark, SF).first()
    assert got["n"] == test.count() and got["rmse"] < guess["rmse"] * 1.1
    assert catalogue.queries()["rf_cls"](spark, SF).first()["brier"] < 0.25
    table_ = catalogue.queries()["importance"](spark, SF).collect()
    assert len(table_) == 64 and math.isclose(sum(r["importance"] for r in table_), 1.0, abs_tol=1e-6)


# --- where rows lie
def tasks(df):
    return df.groupBy(F.spark_partition_id().alias("task")).count().count()


def test_weights_leave_rows_in_their_tasks(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 10 == 0).cast("double").alias("label")).repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = models.balanced_weights(rows)
        assert tasks(out) == 4 and out.count() == 4000
        assert {(r["label"], r["weight"]) for r in out.select("label", "weight").distinct().collect()} == {(1.0, 5.0), (0.0, 4000 / 7200)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_one_task_are_spread(spark):
    one = spark.range(0, 10000, 1, 1)
    out = spread(one, 1000)
    assert tasks(out) == 4 and out.agg(F.count_distinct("id"), F.sum("id")).first() == (10000, 49995000)
    even = spark.range(0, 10000, 1, 4)
    for df, least in ((even, 1000), (one, 10000), (one.limit(0), 1000)):
        assert spread(df, least) is df


def test_matrix_has_each_period_in_all_tasks(spark):
    rows = spark.range(0, 60000, 1, 3).select((F.floor(F.col("id") / 20000) + 1).cast("int").alias("GW"), F.col("id").cast("double").alias("x"), (F.col("id") % 5).alias("y"))
    out = models.feature_matrix(rows, ["y"], ["x"])
    early = out.where("GW <= 1")
    assert tasks(early) == 2 and early.groupBy(F.spark_partition_id()).count().agg(F.min("count")).first()[0] > 8000
    assert out.agg(F.count("*"), F.sum("y"), F.sum("GW")).first() == (60000, 120000.0, 120000)


def test_room_bounds_what_runs_at_once():
    room, seen, most = models.Room(10.0), [], []

    def work(need):
        with room.take(need):
            seen.append(need)
            most.append(sum(seen))
            time.sleep(0.02)
            seen.remove(need)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(work, [3, 4, 5, 6, 10, 2, 4, 6]))
    assert len(most) == 8 and max(most) <= 10 and room.taken == 0
    with room.take(99):  # alone
        assert room.taken == 10
    assert models._row_bytes(models.forest_regressor(trees=100)) > models._row_bytes(models.boosted_regressor()) and models.forest_regressor().getCacheNodeIds()


# --- trees of grids
def panel_of(spark, n, parts):
    """Rows with zeros, negative values, a constant and a yes-or-no feature, ties and missing labels."""
    i = F.col("id")
    rows = spark.range(0, n, 1, parts).select(
        (i % 12 + 1).cast("int").alias("GW"), ((i * 7919) % 1013 - 400).cast("double").alias("a"), ((i * 31) % 17 / 4).alias("b"), F.lit(2.5).alias("c"),
        ((i * 13) % 5 < 2).cast("double").alias("d"), (F.hash("id") % 1000 / 7.0).alias("e"))
    y = F.round(F.col("a") / 300 + F.col("b") * F.col("d") + F.col("e") / 90, 2)
    rows = rows.select("*", y.alias("y"), F.when(F.hash("a", "e") % 9 != 0, F.floor(y)).cast("double").alias("z"))
    return models.feature_matrix(rows, ["y", "z"], ["a", "b", "c", "d", "e"])


def labelled(matrix, target):
    return matrix.where(F.col(target).isNotNull()).select("GW", "features", F.col(target).alias("label"))


@pytest.mark.parametrize("n, parts, alone", [(700, 1, 10**6), (30000, 3, 10**6), (30000, 3, 0)])
def test_grid_trees_are_mllibs(spark, monkeypatch, n, parts, alone):
    monkeypatch.setattr(trees, "ALONE", alone)
    matrix = panel_of(spark, n, parts)
    estimators = {"forest": models.forest_regressor(trees=6, leaf=3, depth=5, features="all"), "boosted": models.boosted_regressor(rounds=5, depth=4)}
    fits = {(m, t, c): (e, t, c, labelled(matrix, t).where(F.col("GW") <= c).count()) for m, e in estimators.items() for t, c in (("y", 4), ("z", 9))}
    got = trees.train(matrix, fits)
    assert got.keys() == fits.keys()
    for (m, t, c), model in got.items():
        early, later = labelled(matrix, t).where(F.col("GW") <= c), labelled(matrix, t).where(F.col("GW") > c)
        want = [r["prediction"] for r in estimators[m].fit(early).transform(later).collect()]
        found = [r["prediction"] for r in model.transform(later).collect()]
        assert len({round(p, 9) for p in found}) > 10 and np.allclose(want, found, rtol=0, atol=1e-9)


def test_sums_of_chunks(spark, monkeypatch):
    """Rows that fill several chunks give the same trees as rows in one."""
    matrix, found = panel_of(spark, 3000, 2), []
    for chunk in (1 << 16, 257):
        monkeypatch.setattr(trees, "CHUNK", chunk)
        folder = trees._folder(spark)
        rows = trees.Rows("z", 9, labelled(matrix, "z").where("GW <= 9").count(), 16, 1)
        binned = trees.write_rows(matrix, [rows], [trees._thresholds(labelled(matrix, "z").where("GW <= 9"), rows.n, 16, 1)], folder)[0]
        assert sum(binned.parts.values()) == rows.n
        binned = binned._replace(state=f"{folder}/s")
        sums = []
        for part in binned.parts:  # written here with this chunk, and read with it
            h = trees.boost_parts([part], binned, 0, 0, None, 1.0, np.zeros(1, np.intp), 1)
            sums.append(h)
        found.append(sum(sums))
    assert np.allclose(found[0], found[1], rtol=1e-12, atol=0) and found[0][0, 0].sum() > 1000


def test_a_level_of_all_boosted_fits_is_one_job(spark, monkeypatch):
    monkeypatch.setattr(trees, "ALONE", 0)
    matrix = panel_of(spark, 900, 2)
    spark.sparkContext.setJobGroup("levels", "levels")
    try:
        grid = models.run_grid(matrix, {"boosted": lambda: models.boosted_regressor(rounds=20, depth=3)}, ["y", "z"], [4, 9], [1]).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("levels"))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert len(grid) == 4 and all(r["error"] is None for r in grid) and 60 <= jobs < 120  # 4 fits of 20 trees and 3 levels


def test_what_mllib_has_to_fit(spark):
    boosted, forest = models.boosted_regressor, models.forest_regressor
    assert trees.handles(boosted()) and trees.handles(forest(features="all"))
    for e in (forest(), boosted(sample=0.8), boosted(columns=0.5), forest(features="all").setMaxBins(300), boosted().setLossType("absolute"),
              forest(features="all").setBootstrap(False), forest(features="all").setWeightCol("w"), models.forest_classifier(), ValueError("x")):
        assert not trees.handles(e)
    one = spark.createDataFrame([(g, float(v), float(v % 3), float("nan") if v == 5 else float(v), 1.0) for g in (1, 2, 3) for v in range(30)],
                                "GW int, x double, z double, y double, c double")
    boosted_only = {"boosted": lambda: boosted(rounds=2, depth=2)}
    bad = models.run_grid(models.feature_matrix(one, ["y", "z"], ["x"]), boosted_only, ["y", "z"], [2], [1]).collect()
    assert {r["target"]: r["error"] is None for r in bad} == {"y": False, "z": True}  # MLlib takes no NaN
    flat = models.run_grid(models.feature_matrix(one, ["z"], ["c"]), boosted_only, ["z"], [2], [1]).first()
    assert flat["error"] is None and math.isclose(flat["mae"], 2 / 3)


def test_parts_are_dealt_in_order():
    parts = {2: 10, 3: 10, 5: 30, 8: 10, 9: 20}
    for tasks in (1, 2, 3, 5, 9):
        out = trees.deal(parts, tasks)
        assert [p for some in out for p in some] == list(parts) and len(out) <= tasks and all(out)
    assert trees.deal(parts, 9) == [[2], [3], [5], [8], [9]] and max(sum(parts[p] for p in some) for some in trees.deal(parts, 2)) <= 50


def test_threads_have_their_pools(spark):
    gate = threading.Barrier(4)

    def work(x):
        gate.wait()
        return x, spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    got = in_threads(spark, work, [1, 2, 3, 4], 4)
    assert [x for x, _ in got] == [1, 2, 3, 4] and len({pool for _, pool in got}) == 4


# --- prepared features
def test_the_lists_have_their_lengths():
    assert {k: len(v) for k, v in models.FEATURES.items()} == {"goals": 15, "assists": 12, "cards": 10, "bonus": 18, "clean_sheets": 7, "backtest": 4, "comparison": 5}


def test_steps_are_read_by_scoring(spark):
    todo = prepare.Recipe(("m", "z", "flat"), {"m": ("team", "g")}, {"z": "x", "flat": "c"})
    train = spark.createDataFrame([("A", 1.0, 1.0, 5.0), ("A", 3.0, 3.0, 5.0), ("B", 8.0, None, 5.0), (None, 100.0, 2.0, 5.0)], "team string, g double, x double, c double")
    steps = prepare.fit_preparation(train, todo)
    stored = spark.read.parquet(steps.saved_path)
    later = spark.createDataFrame([(1, "A", 4.0, 1.0, 9.0), (2, "Z", None, 1.0, 9.0), (3, None, 2.0, 1.0, None)], "id int, team string, x double, g double, c double")
    got = {r["id"]: (r["m"], r["z"], r["flat"]) for r in prepare.prepared(later, stored, todo).collect()}
    sd = math.sqrt(2 / 3)
    # A has mean 2, unseen teams the mean of the groups' means; a missing score is 0, and so is one without deviation
    assert got[1][0] == 2.0 and math.isclose(got[1][1], 2 / sd) and got[1][2] == 0.0
    assert got[2] == (5.0, 0.0, 0.0) and got[3][0] == 5.0 and got[3][1] == 0.0
    assert prepare.prepared(later.limit(0), stored, todo).count() == 0
