"""Queries: splits, models, metrics, back-tests."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelkit.operators import features, models, report
from panelkit.plans.catalogue import query
from panelkit.plans.views import panel, table, wide_panel
from panelkit.shared import saved, spread


def _hash(keys: str, seed: int) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, 8))::UBIGINT / 4294967296.0)"


@query("M2", "seq:int train:flag", f"SELECT seq, {_hash('seq::VARCHAR', 42)} < 0.8 AS train FROM v_panel")
def split80(spark, sf):
    return panel(spark, sf).select("seq", models.split(None, ["seq"]).alias("train"))


@query("M3", "seq:int position train:flag", """WITH h AS (SELECT seq, position, md5(concat_ws('|', seq::VARCHAR, '42'))[1:15] AS h FROM v_panel),
r AS (SELECT seq, position, row_number() OVER (PARTITION BY position ORDER BY h, seq) <= floor(count(*) OVER (PARTITION BY position) * 0.75 + 0.5) AS train FROM h)""")
def stratified_split(spark, sf):
    return models.stratified(panel(spark, sf), "position", ["seq"])


@query("M1", "seq:int n:int total:num", "SELECT seq, 3 AS n, minutes + threat + bps AS total FROM v_panel WHERE bps IS NOT NULL AND minutes IS NOT NULL")
def feature_matrix(spark, sf):
    rows = models.feature_vector(panel(spark, sf).dropna(subset=["minutes", "threat", "bps"]), ["minutes", "threat", "bps"])
    v = vector_to_array("features")
    return rows.select("seq", F.size(v).alias("n"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("M8", "alpha:num slope:num intercept:num", """WITH s AS (SELECT regr_sxx(influence, threat) AS xx, regr_sxy(influence, threat) AS xy, avg(threat) AS x, avg(influence) AS y FROM v_panel),
r AS (SELECT a AS alpha, xy / (xx + a) AS slope, y - xy / (xx + a) * x AS intercept FROM s, (VALUES (0.0), (1.0)) t(a))""")
def linear_and_ridge(spark, sf):
    p = panel(spark, sf)
    one = lambda a: models.ridge_one(p, "threat", "influence", a).withColumn("alpha", F.lit(a))
    return one(0.0).union(one(1.0))


_BACK = """WITH g AS (SELECT target, cutoff, win FROM (VALUES ('goals_scored'), ('assists')) a(target), (VALUES (10), (15), (20)) b(cutoff), (VALUES (1), (2)) c(win)),
y AS (SELECT GW, position, 'goals_scored' AS target, goals_scored::DOUBLE AS y FROM v_panel UNION ALL SELECT GW, position, 'assists', assists FROM v_panel),
tr AS (SELECT g.target, cutoff, win, position, avg(y) AS m, count(*) AS n FROM g JOIN y ON y.target = g.target AND GW <= cutoff GROUP BY ALL),
te AS (SELECT g.target, g.cutoff, g.win, y.y, tr.m AS p FROM g JOIN y ON y.target = g.target AND GW > cutoff AND GW <= cutoff + win
  JOIN tr ON tr.target = g.target AND tr.cutoff = g.cutoff AND tr.win = g.win AND tr.position = y.position),
me AS (SELECT target, cutoff, win, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, count(*) AS n_test FROM te GROUP BY ALL),
bt AS (SELECT me.*, (SELECT sum(n) FROM tr WHERE tr.target = me.target AND tr.cutoff = me.cutoff AND tr.win = me.win) AS n_train FROM me)"""


def _backtest(spark, sf, group="position"):
    return models.backtest_means(panel(spark, sf), ["goals_scored", "assists"], [10, 15, 20], [1, 2], group)


@query("M13 M16 M11 M14", "target cutoff:int window:int mae:num rmse:num r2:num n_train:int n_test:int", _BACK + ', r AS (SELECT *, win AS "window" FROM bt)')
def backtest_mean(spark, sf):
    return _backtest(spark, sf)


@query("M12", "position brier:num n:int", """WITH m AS (SELECT position, avg(clean_sheets) AS p FROM v_panel WHERE GW <= 20 GROUP BY position),
r AS (SELECT position, avg((p - clean_sheets) * (p - clean_sheets)) AS brier, count(*) AS n FROM v_panel JOIN m USING (position) WHERE GW > 20 GROUP BY position)""")
def brier(spark, sf):
    p = panel(spark, sf)
    means = features.role_baseline(p.where("GW <= 20"), "clean_sheets")
    return models.brier(p.where("GW > 20").join(F.broadcast(means), "position"), "clean_sheets", "role_mean", ("position",))  # a row for each role


@query("D15", "cutoff:int goals_scored:num assists:num", _BACK + """, r AS (SELECT cutoff, round(avg(mae) FILTER (target = 'goals_scored'), 6) AS goals_scored, round(avg(mae) FILTER (target = 'assists'), 6) AS assists FROM bt GROUP BY cutoff)""")
def pivot_metric(spark, sf):
    return report.pivot_metric(_backtest(spark, sf), "cutoff", "target", ["goals_scored", "assists"], "mae")


@query("D16", "best value:num", _BACK + ", b AS (SELECT target, avg(mae) AS m FROM bt GROUP BY target), r AS (SELECT arg_min(target, m) AS best, min(m) AS value FROM b)")
def best_model(spark, sf):
    return report.best_model(_backtest(spark, sf), "target", "mae")


_DIM = 64


def _vectors(spark, sf):
    """Embeddings as feature columns, with a value that depends on them and a rare class."""
    e = table(spark, sf, "embeddings")
    xs = [F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(_DIM)]
    return e.select("vec_id", *xs, F.col("label").cast("double").alias("y"), (F.col("label") == 3).cast("double").alias("label"))


_X = [f"x{i}" for i in range(_DIM)]


def _parts(spark, sf):
    rows = models.feature_vector(_vectors(spark, sf), _X).withColumn("train", models.split(None, ["vec_id"])).drop(*_X)
    return spread(rows.where("train"), 1000), rows.where("NOT train")


@query("M4 M10 M11", "mae:num rmse:num r2:num n:int")
def rf_reg(spark, sf):
    train, test = _parts(spark, sf)
    model = models.forest_regressor(trees=200, leaf=5, label="y").fit(train)
    return models.error_metrics(model.transform(test), "y", "prediction")


@query("M5 M12", "brier:num n:int")
def rf_cls(spark, sf):
    train, test = _parts(spark, sf)
    model = models.forest_classifier(trees=400, leaf=20).fit(models.balanced_weights(train))
    scored = model.transform(test)
    return models.brier(scored.withColumn("p", models.positive_probability(scored)), "label", "p")


@query("M6 I5", "vec_id:int prob:num")
def platt(spark, sf):
    train, test = _parts(spark, sf)
    model = models.forest_regressor(trees=500, leaf=30, features="all").fit(train)
    scored = saved(model.transform(test).select("vec_id", "label", F.col("prediction").alias("score")), "scored")
    p = models.platt(scored, "score").probability(F.col("score"))
    return scored.select("vec_id", F.bround(F.least(p, F.lit(0.5)), 2).alias("prob"))


@query("M7", "mae:num rmse:num r2:num n:int")
def gbt(spark, sf):
    train, test = _parts(spark, sf)
    model = models.boosted_regressor(rounds=100, rate=0.1, depth=3, label="y").fit(train)
    return models.error_metrics(model.transform(test), "y", "prediction")


@query("M9", "feature importance:num")
def importance(spark, sf):
    train, _ = _parts(spark, sf)
    return models.importance_table(models.forest_regressor(trees=300, leaf=10, label="y").fit(train), _X, spark)


@query("M7 M13 M14", "model target cutoff:int window:int mae:num rmse:num r2:num n_train:int n_test:int error")
def model_grid(spark, sf):
    """Forest and boosting at the comparison's sizes beside the mean and linear models of ``backtest_mean`` and ``linear_backtest``."""
    p = wide_panel(spark, sf)
    names = models.feature_list(p, models.FEATURES["comparison"], {c: c for c in models.COMPARISON_OPTIONAL})
    grid = {"forest": lambda: models.forest_regressor(trees=100, leaf=1, features="all"), "boosted": lambda: models.boosted_regressor(rounds=100, rate=0.1, depth=6)}
    return models.run_grid(models.feature_matrix(p, ["goals_scored", "assists"], names), grid, ["goals_scored", "assists"], [10, 15, 20], [1, 2])
