"""Queries: regressions for a whole grid, exact strata, quantiles, calibration, prepared feature sets and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import models, prepare, regression, report
from panelkit.plans.catalogue import query
from panelkit.plans.q_features import _strength_sql
from panelkit.plans.views import WIDE_CTE, teams, wide_panel
from panelkit.shared import saved

_GOALS = ["minutes", "threat", "creativity", "ict_index", "starts", "xP", "expected_goals"]
_TARGETS, _CUTOFFS, _WINDOWS, _ALPHAS = ["goals_scored", "assists"], [10, 15, 20], [1, 2], [0.0, 1.0]


def _eliminated(cells: str, keys: str, features: list[str], target: str, alpha: str, out: str) -> str:
    """Steps that solve the normal equations of each cell: ``out`` has keys, n, the weights w and the intercept."""
    p = len(features)
    cols = [*features, target]
    line = lambda i: "[" + ", ".join(
        f"n * covar_pop({cols[i]}, {c})" + (f" + {alpha}" if i == j else "") for j, c in enumerate(cols)).replace("n *", "count(*) *") + "]"
    steps = [f"{out}_0 AS (SELECT {keys}, count(*) AS n, [{', '.join(f'avg({c})' for c in cols)}] AS mean, [{', '.join(line(i) for i in range(p))}] AS m FROM {cells} GROUP BY {keys})"]
    for k in range(1, p + 1):
        steps.append(f"""{out}_{k} AS (SELECT {keys}, n, mean, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda x: x / m[{k}][{k}])
  ELSE list_transform(r, lambda x, j: x - r[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m FROM {out}_{k - 1})""")
    w = ", ".join(f"m[{i}][{p + 1}]" for i in range(1, p + 1))
    steps.append(f"{out} AS (SELECT {keys}, n, [{w}] AS w, mean[{p + 1}] - ({' + '.join(f'm[{i}][{p + 1}] * mean[{i}]' for i in range(1, p + 1))}) AS intercept FROM {out}_{p})")
    return ",\n".join(steps)


_THERE = " AND ".join(f"{c} IS NOT NULL" for c in _GOALS)
_LONG = f"""WITH {WIDE_CTE},
g AS (SELECT target, cutoff, alpha FROM (VALUES ('goals_scored'), ('assists')) a(target), (VALUES (10), (15), (20)) b(cutoff), (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) c(alpha)),
y AS (SELECT *, 'goals_scored' AS target, goals_scored::DOUBLE AS y FROM v_wide WHERE {_THERE} UNION ALL SELECT *, 'assists', assists FROM v_wide WHERE {_THERE}),
tr AS (SELECT g.cutoff, g.alpha, y.* FROM g JOIN y ON y.target = g.target AND GW <= cutoff WHERE y IS NOT NULL),
{_eliminated('tr', 'target, cutoff, alpha', _GOALS, 'y', 'alpha', 'fit')}"""


@query("M8", "target cutoff:int alpha:num n:int feature weight:near", _LONG + f""",
r AS (SELECT target, cutoff, alpha, n, unnest(['intercept', {', '.join(repr(c) for c in _GOALS)}]) AS feature, unnest(list_prepend(intercept, w)) AS weight FROM fit)""")
def linear_weights(spark, sf):
    cells = regression.linear_cells(wide_panel(spark, sf), _GOALS, _TARGETS, _CUTOFFS, _ALPHAS)
    names = F.array(F.lit("intercept"), *map(F.lit, _GOALS))
    return cells.select("target", "cutoff", "alpha", "n", F.explode(F.arrays_zip(
        names.alias("feature"), F.concat(F.array("intercept"), F.col("weights")).alias("weight"))).alias("x")).select("target", "cutoff", "alpha", "n", "x.*")


@query("M8 M11 M13 M14", "target cutoff:int window:int alpha:num mae:near rmse:near r2:near n_train:int n_test:int", _LONG + f""",
te AS (SELECT fit.cutoff, win, fit.alpha, n, y.target, y.y, fit.intercept + {' + '.join(f'w[{i + 1}] * {c}' for i, c in enumerate(_GOALS))} AS p
  FROM fit JOIN (VALUES (1), (2)) v(win) ON true JOIN y ON y.target = fit.target AND GW > fit.cutoff AND GW <= fit.cutoff + win WHERE y.y IS NOT NULL),
r AS (SELECT target, cutoff, win AS "window", alpha, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2,
  any_value(n) AS n_train, count(*) AS n_test FROM te GROUP BY ALL)""")
def linear_backtest(spark, sf):
    return regression.linear_backtest(wide_panel(spark, sf), _GOALS, _TARGETS, _CUTOFFS, _WINDOWS, _ALPHAS)


@query("D7", "position q:num value:num", """WITH v AS (SELECT position, quantile_cont(influence, [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]) AS x FROM v_panel GROUP BY position),
r AS (SELECT position, unnest([0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]) AS q, unnest(x) AS value FROM v)""")
def quantiles_by_role(spark, sf):
    return report.exact_quantiles(wide_panel(spark, sf), "influence", [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0], ("position",))


def _set_sql(name: str) -> str:
    """Steps up to ``rows_``: panel rows with the columns that a named set is made from."""
    src, home = "v_wide", "was_home"
    rolled = ", ".join(f"avg({c}) OVER (PARTITION BY name ORDER BY GW, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll3_{c}" for c in prepare.ROLLED.get(name, []))
    if name == "clean_sheets":
        src = "(SELECT * FROM v_wide WHERE position IN ('GK', 'GKP', 'DEF') AND minutes >= 60)"
    flags = ", ".join(f"CASE WHEN position = '{v}' THEN 1 ELSE 0 END AS {f}" for f, v in prepare.ROLE_FLAGS.items())
    kind, same, own, opp = ("defence", True, "team_def", "opp_att") if name == "clean_sheets" else ("attack", False, "team_attacking", "opp_defending")
    strength = _strength_sql(kind, home, "opponent_team", "rolled", same)
    return f"""WITH {WIDE_CTE}, rolled AS (SELECT *{', ' + rolled if rolled else ''} FROM {src}), strong AS ({strength}),
rows_ AS (SELECT * EXCLUDE (was_home), was_home::INT AS was_home, own_k AS {own}, opp_k AS {opp}, {flags} FROM strong)"""


def _matrix_sql(name: str) -> str:
    feats = models.FEATURES[name]
    if name == "goals":
        return _set_sql(name) + ", r AS (SELECT seq, GW, " + ", ".join(f"coalesce({f}::DOUBLE, 0) AS {f}" for f in feats) + " FROM rows_)"
    fit = ", ".join(f"avg({f}) FILTER (GW <= 25) AS m_{f}" for f in feats)
    return _set_sql(name) + f", m AS (SELECT {fit} FROM rows_), r AS (SELECT seq, GW, " + ", ".join(f"coalesce({f}::DOUBLE, m_{f}) AS {f}" for f in feats) + " FROM rows_, m)"


def _columns(name: str) -> str:
    return " ".join(["seq:int", "GW:int", *[f"{f}:num" for f in models.FEATURES[name]]])


def _matrix(spark, sf, name):
    """The named set's matrix of all rows; its steps are fitted on GW <= 25, stored, and read again."""
    rows, todo = prepare.model_rows(wide_panel(spark, sf), teams(spark, sf), name), prepare.recipe(name)
    steps = prepare.fit_preparation(rows.where("GW <= 25"), todo)
    return prepare.prepared(rows, spark.read.parquet(steps.saved_path), todo).select("seq", "GW", *todo.features)


@query("M1 M15", _columns("goals"), _matrix_sql("goals"))
def matrix_goals(spark, sf):
    return _matrix(spark, sf, "goals")


@query("M1 D18 E1", _columns("assists"), _matrix_sql("assists"))
def matrix_assists(spark, sf):
    return _matrix(spark, sf, "assists")


@query("M1 D18 E1", _columns("cards"), _matrix_sql("cards"))
def matrix_cards(spark, sf):
    return _matrix(spark, sf, "cards")


@query("M1 D18 E1", _columns("bonus"), _matrix_sql("bonus"))
def matrix_bonus(spark, sf):
    return _matrix(spark, sf, "bonus")


_Z = lambda c: f"(({c} - avg({c}) FILTER (GW <= 25) OVER ()) / nullif(stddev_pop({c}) FILTER (GW <= 25) OVER (), 0))"
_MEAN_OF = lambda key, col: f"""(SELECT {key} AS k, avg({col}) AS v FROM rows_ WHERE GW <= 25 AND {key} IS NOT NULL GROUP BY {key})"""
_CLEAN = _set_sql("clean_sheets") + f""",
ta AS {_MEAN_OF('team', 'clean_sheets')}, oa AS {_MEAN_OF('opponent_team', 'clean_sheets')}, xa AS {_MEAN_OF('team', 'expected_goals_conceded')},
mapped AS (SELECT rows_.*, coalesce(ta.v, (SELECT avg(v) FROM ta)) AS team_cs_avg, coalesce(oa.v, (SELECT avg(v) FROM oa)) AS opp_cs_allow, coalesce(xa.v, (SELECT avg(v) FROM xa)) AS team_xgc
  FROM rows_ LEFT JOIN ta ON ta.k = team LEFT JOIN oa ON oa.k = opponent_team LEFT JOIN xa ON xa.k = team),
r AS (SELECT seq, GW, coalesce(roll3_minutes, avg(roll3_minutes) FILTER (GW <= 25) OVER ()) AS roll3_minutes, coalesce({_Z('team_def')}, 0) AS team_def_z,
  coalesce({_Z('opp_att')}, 0) AS opp_att_z, coalesce({_Z('fixture_difficulty')}, 0) AS fixture_diff_z, team_cs_avg, opp_cs_allow, coalesce({_Z('team_xgc')}, 0) AS team_xgc_z FROM mapped)"""


@query("M1 D5 D6 D18 C10", _columns("clean_sheets"), _CLEAN)
def matrix_clean_sheets(spark, sf):
    return _matrix(spark, sf, "clean_sheets")


_F = models.FEATURES["goals"]
_STANDARD = ", ".join(f"coalesce(({f} - avg({f}) FILTER (GW <= 25) OVER ()) / nullif(stddev_pop({f}) FILTER (GW <= 25) OVER (), 0), 0) AS z_{f}" for f in _F)
_SCORE = _set_sql("goals") + f""",
z AS (SELECT seq, name, GW, goals_scored::DOUBLE AS y, {_STANDARD} FROM rows_),
tr AS (SELECT *, 1 AS one FROM z WHERE GW <= 25 AND y IS NOT NULL),
{_eliminated('tr', 'one', [f'z_{f}' for f in _F], 'y', '1.0', 'fit')},
r AS (SELECT seq, name, GW, intercept + {' + '.join(f'w[{i + 1}] * z_{f}' for i, f in enumerate(_F))} AS prediction FROM z, fit WHERE GW > 25)"""


@query("M10 M1 M8", "seq:int name GW:int prediction:near", _SCORE)
def score_next(spark, sf):
    """Ridge on the goals set's standard scores, trained on GW <= 25; later rows are scored from the stored steps and the stored model."""
    rows, todo = prepare.model_rows(wide_panel(spark, sf), teams(spark, sf), "goals"), prepare.recipe("goals", standardise=True)
    steps = prepare.fit_preparation(rows.where("GW <= 25"), todo)
    train = prepare.prepared(rows.where("GW <= 25"), spark.read.parquet(steps.saved_path), todo)
    model = saved(regression.solve(regression.cross_products(train, list(todo.features), "goals_scored"), [1.0]), "model")
    later = prepare.prepared(rows.where("GW > 25"), spark.read.parquet(steps.saved_path), todo)
    scored = later.crossJoin(F.broadcast(spark.read.parquet(model.saved_path)))  # one model
    return scored.select("seq", "name", "GW", regression.predicted(list(todo.features)))


def _newton_sql(steps: int) -> str:
    out = ["s AS (SELECT influence / 10 AS x, clean_sheets::DOUBLE AS y FROM v_panel WHERE influence IS NOT NULL AND clean_sheets IS NOT NULL)",
           "n0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for k in range(1, steps + 1):
        out.append(f"""n{k} AS (SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a, b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM (
  SELECT any_value(a) AS a, any_value(b) AS b, sum((p - y) * x) + any_value(a) AS ga, sum(p - y) AS gb, sum(p * (1 - p) * x * x) + 1 AS haa, sum(p * (1 - p) * x) AS hab, sum(p * (1 - p)) AS hbb
  FROM (SELECT x, y, a, b, 1 / (1 + exp(-(a * x + b))) AS p FROM s, n{k - 1})))""")
    return "WITH " + ",\n".join(out)


@query("M6 M12", "slope:near intercept:near brier:near n:int", _newton_sql(12) + """,
r AS (SELECT any_value(a) AS slope, any_value(b) AS intercept, avg(pow(1 / (1 + exp(-(a * x + b))) - y, 2)) AS brier, count(*) AS n FROM s, n12)""")
def calibration(spark, sf):
    rows = wide_panel(spark, sf).select((F.col("influence") / 10).alias("score"), F.col("clean_sheets").cast("double").alias("label"))
    fitted = models.platt(rows, "score")
    out = models.brier(rows.select("label", fitted.probability(F.col("score")).alias("p")), "label", "p")
    return out.select(F.lit(fitted.slope).alias("slope"), F.lit(fitted.intercept).alias("intercept"), "brier", "n")
