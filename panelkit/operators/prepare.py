"""Named feature sets, and preprocessing that is fitted once, stored, and read again by scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import clean, features
from panelkit.operators.models import FEATURES
from panelkit.shared import saved

# Fixed by the models: columns whose rolling means the bonus model uses, and role flags.
BONUS_ROLLED = ["minutes", "goals_scored", "assists", "clean_sheets", "saves", "yellow_cards", "red_cards", "threat", "creativity", "influence", "ict_index"]
ROLE_FLAGS = {"is_forward": "FWD", "is_midfielder": "MID", "is_defender": "DEF", "is_goalkeeper": "GK"}
ROLLED = {"assists": ["minutes", "creativity"], "cards": ["minutes", "yellow_cards", "red_cards"], "bonus": BONUS_ROLLED, "clean_sheets": ["minutes"]}


@dataclass(frozen=True)
class Recipe:
    """What is fitted: group means (alias -> (key, column)), standard scores (alias -> column), and what fills missing features."""

    features: tuple
    maps: dict = field(default_factory=dict)
    scores: dict = field(default_factory=dict)
    fill: str = "mean"  # or "zero"


def recipe(name: str, standardise: bool = False) -> Recipe:
    """The recipe of a named set; with ``standardise`` each feature is replaced by its standard score."""
    maps, scores = {}, {}
    if name == "clean_sheets":
        maps = {"team_cs_avg": ("team", "clean_sheets"), "opp_cs_allow": ("opponent_team", "clean_sheets"), "team_xgc": ("team", "expected_goals_conceded")}
        scores = {"team_def_z": "team_def", "opp_att_z": "opp_att", "fixture_diff_z": "fixture_difficulty", "team_xgc_z": "team_xgc"}
    if standardise:
        scores = scores | {f: f for f in FEATURES[name] if f not in scores}
    return Recipe(tuple(FEATURES[name]), maps, scores, "zero" if name == "goals" else "mean")


def model_rows(df: DataFrame, teams: DataFrame, name: str) -> DataFrame:
    """Panel rows with the columns from which the named set's features are made: strengths, rolling means, role flags.

    Clean sheets are modelled for goalkeepers and defenders of 60 minutes or more; their rolling means run after that filter.
    """
    if name == "clean_sheets":
        df = df.where(F.col("position").isin("GK", "GKP", "DEF") & (F.col("minutes") >= 60))
    if name in ROLLED:
        df = features.rolling_mean(df, ROLLED[name])
    if name == "clean_sheets":
        df = features.enrich_strength(df, teams, "defence").withColumnsRenamed({"team_defence": "team_def", "opp_attack": "opp_att"})
    else:
        df = features.enrich_strength(df, teams).withColumnsRenamed({"team_attack": "team_attacking", "opp_defence": "opp_defending"})
    df = df.withColumn("was_home", F.col("was_home").cast("int")) if "was_home" in df.columns else df
    return clean.one_hot(df, "position", ROLE_FLAGS)


def _with_maps(df: DataFrame, steps: DataFrame, todo: Recipe) -> DataFrame:
    """Group means by key; keys that the fit has not seen get the mean of the group means."""
    for alias, (key, _) in todo.maps.items():
        means = steps.where((F.col("step") == "map") & (F.col("feature") == alias)).select(F.col("key").alias("_key"), F.col("value").alias("_value"))
        rest = F.broadcast(means.agg(F.avg("_value").alias("_rest")))  # one row
        df = df.drop(alias).join(means, F.col(key).cast("string") == F.col("_key"), "left").crossJoin(rest)
        df = df.withColumn(alias, F.coalesce("_value", "_rest")).drop("_key", "_value", "_rest")
    return df


def fit_preparation(train: DataFrame, todo: Recipe, label: str = "preparation") -> DataFrame:
    """The fitted steps as a stored table (step, feature, key, value); its path is ``saved_path``.

    map: a group mean of ``feature`` by ``key``; mean and sd: of a standard score's column; fill: the mean of a feature.
    """
    none = F.lit(None).cast("string")
    maps = None
    for alias, (key, col) in todo.maps.items():
        part = train.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.avg(col).alias("value")).select(
            F.lit("map").alias("step"), F.lit(alias).alias("feature"), "key", "value")
        maps = part if maps is None else maps.unionByName(part)
    steps = saved(maps, f"{label}-maps") if maps is not None else None
    rows = _with_maps(train, steps, todo) if steps is not None else train
    wanted = list(dict.fromkeys([*todo.scores.values(), *[f for f in todo.features if f not in todo.scores]]))
    one = rows.agg(*[F.struct(F.avg(F.col(c).cast("double")).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("sd")).alias(c) for c in wanted])
    numbers = one.select(F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.lit(c).alias("feature"), none.alias("key"), F.col(f"`{c}`")[s].alias("value")) for c in wanted for s in ("mean", "sd")])).alias("x")).select("x.*")
    return saved(numbers if steps is None else steps.unionByName(numbers), label)


def prepared(df: DataFrame, steps: DataFrame, todo: Recipe) -> DataFrame:
    """``df`` with the features of the recipe as doubles without gaps, from stored steps alone.

    A standard score is missing where the deviation is 0 or missing; missing features become the fit's mean (0 for a standard
    score) or zero, as the recipe says, and 0 where the fit has no mean.
    """
    rows = _with_maps(df, steps, todo)
    columns = list(dict.fromkeys([*todo.scores.values(), *[f for f in todo.features if f not in todo.scores]]))
    pick = lambda c, s: F.max(F.when((F.col("step") == s) & (F.col("feature") == c), F.col("value")))
    one = steps.agg(*[pick(c, s).alias(f"_{s}_{c}") for c in columns for s in ("mean", "sd")])
    rows = rows.crossJoin(F.broadcast(one))  # one row
    out = {}
    for f in todo.features:
        c = todo.scores.get(f, f)
        if f in todo.scores:
            out[f] = F.coalesce(F.try_divide(F.col(c).cast("double") - F.col(f"_mean_{c}"), F.col(f"_sd_{c}")), F.lit(0.0))
        else:
            out[f] = F.coalesce(F.col(c).cast("double"), F.lit(0.0) if todo.fill == "zero" else F.col(f"_mean_{c}"), F.lit(0.0))
    return rows.withColumns(out).drop(*one.columns)
