"""Schedules, strengths, group means, profiles and rolling features. All joins are equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.clean import columns_like


def attach_fixture(df: DataFrame, fixtures: DataFrame, teams: DataFrame, order: str = "seq") -> DataFrame:
    """Opponent id and name and the home flag of each row's team in its period GW.

    Of several matches the first by ``order`` (file order; "kickoff" as an option) counts; without a match the
    opponent is null and "Unknown" and the flag false. ``df`` needs team_id and GW.
    """
    side = lambda team, other, home: fixtures.select(
        F.col("GW").alias("_gw"), F.col(team).alias("_team"), F.col(other).alias("opp_id"), F.lit(home).alias("at_home"), F.struct(order, "seq").alias("_o"))
    both = side("team_h", "team_a", True).union(side("team_a", "team_h", False))
    first = both.groupBy("_gw", "_team").agg(F.min_by(F.struct("opp_id", "at_home"), "_o").alias("_m")).select(
        "_gw", "_team", "_m.opp_id", "_m.at_home")
    names = teams.select(F.col("id").alias("opp_id"), F.col("name").alias("opponent"))
    out = df.join(first.join(names, "opp_id", "left"), (F.col("GW") == F.col("_gw")) & (F.col("team_id") == F.col("_team")), "left")
    return out.drop("_gw", "_team").withColumns({
        "at_home": F.coalesce("at_home", F.lit(False)), "opponent": F.coalesce("opponent", F.lit("Unknown"))})


def enrich_strength(df: DataFrame, teams: DataFrame, kind: str = "attack", default: int = 1100,
                    home: str = "was_home", opponent: str = "opponent_team", opp_overall_same_venue: bool | None = None) -> DataFrame:
    """Own strength by venue, the opponent's by the other venue, and their difference.

    ``kind`` attack sets own attack against the opponent's defence, defence the reverse. A missing home flag counts as
    home, an unknown team has the default strength. By default the opponent's overall strength is taken at its own
    venue for attack and at the team's venue flag for defence.
    """
    other = {"attack": "defence", "defence": "attack"}[kind]
    same = (kind == "defence") if opp_overall_same_venue is None else opp_overall_same_venue
    cols = [f"{k}_{v}" for k in ("attack", "defence", "overall") for v in ("home", "away")]
    own = teams.select(F.col("name").alias("_own"), *[F.col(c).alias(f"_o_{c}") for c in cols])
    opp = teams.select(F.col("id").alias("_opp"), *[F.col(c).alias(f"_p_{c}") for c in cols])
    at_home = F.coalesce(F.col(home), F.lit(True))
    pick = lambda side, k, at: F.coalesce(F.when(at, F.col(f"{side}{k}_home")).otherwise(F.col(f"{side}{k}_away")), F.lit(default))
    out = df.join(own, F.col("team") == F.col("_own"), "left").join(opp, F.col(opponent) == F.col("_opp"), "left")
    out = out.withColumns({
        f"team_{kind}": pick("_o_", kind, at_home), "team_overall": pick("_o_", "overall", at_home),
        f"opp_{other}": pick("_p_", other, ~at_home), "opp_overall": pick("_p_", "overall", at_home if same else ~at_home)})
    out = out.drop("_own", "_opp", *[f"_o_{c}" for c in cols], *[f"_p_{c}" for c in cols])
    return out.withColumn("fixture_difficulty", (
        (F.col(f"team_{kind}") - F.col(f"opp_{other}")) + (F.col("team_overall") - F.col("opp_overall"))) / 100.0)


def rolling_mean(df: DataFrame, cols: list[str], n: int = 3, min_periods: int = 1, keys=("name",), order=("GW", "seq"), shift: int = 0) -> DataFrame:
    """Mean of the last ``n`` rows of each key, missing values skipped; ``shift=1`` leaves the row itself out.

    Rows without a key would all meet in one task; they get missing means outside the window.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1) - shift, -shift)
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    known, rest = df.where(there), df.where(~there)
    out = known.withColumns({f"roll{n}_{c}": F.when(F.count(c).over(w) >= min_periods, F.avg(c).over(w)) for c in cols})
    return out.unionByName(rest.withColumns({f"roll{n}_{c}": F.lit(None).cast("double") for c in cols}))


def rolling_mean_ranged(df: DataFrame, cols: list[str], n: int = 3, min_periods: int = 1, keys=("name",), order=("GW", "seq"), shift: int = 0,
                        ranges: int = 64) -> DataFrame:
    """As ``rolling_mean``, for entities that may be larger than a task: the same rows without a shuffle on the keys alone.

    The rows are cut into about ``ranges`` ranges of (keys, order) that may divide an entity. Each range takes along the
    last rows of the ranges before it that a window can reach, which are computed and then left out. A sample of keys by
    hash only sets the cuts; about 40 keys a range are read for it when the function is called. (keys, order) must be unique.
    """
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    place = F.struct(*keys, *order)
    known, rest = df.where(there), df.where(~there)
    counted = known.select(place.alias("_o"), F.xxhash64(*keys, *order).alias("_h"))
    total = counted.count()
    one_in = max(1, total // (40 * ranges))
    seen = [r["_o"] for r in counted.where(F.pmod("_h", F.lit(one_in)) == 0).select("_o").sort("_o").collect()]  # about 40 * ranges keys
    kind = known.select(place.alias("_o")).schema["_o"].dataType
    cuts = [seen[i * len(seen) // ranges] for i in range(1, ranges)] if len(seen) >= ranges else seen
    bounds = F.broadcast(df.sparkSession.createDataFrame([(cuts,)], T.StructType([T.StructField("_cuts", T.ArrayType(kind))])))  # one row
    steps = F.array(*[F.lit(2**s) for s in reversed(range(max(1, len(cuts).bit_length())))])
    size = len(cuts)
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s <= size) & (place >= F.get("_cuts", p + s - 1)), p + s).otherwise(p))
    rows = known.crossJoin(bounds).withColumn("_range", at).drop("_cuts")
    reach = n - 1 + shift
    rows = rows.withColumn("_own", F.lit(True))
    if reach:
        back = F.row_number().over(Window.partitionBy("_range").orderBy(*[F.col(c).desc() for c in (*keys, *order)]))
        tail = rows.withColumn("_back", back).where(F.col("_back") <= reach)  # at most ``reach`` rows of each range
        per_range = rows.groupBy("_range").agg(F.count("*").alias("_n"))
        # a range's tail reaches the next ranges as long as fewer than ``reach`` rows lie between; empty ranges do not count
        order_ = Window.orderBy("_range")  # one row a range
        held = per_range.withColumn("_i", F.row_number().over(order_)).withColumn("_upto", F.sum(F.least(F.col("_n"), F.lit(reach))).over(order_))
        source = held.select(F.col("_range").alias("_from"), F.col("_i").alias("_fi"), F.col("_upto").alias("_fu"))
        goal = held.select(F.col("_range").alias("_to"), F.col("_i").alias("_ti"), (F.col("_upto") - F.least(F.col("_n"), F.lit(reach))).alias("_tu"))
        hops = source.withColumn("_ti", F.explode(F.sequence(F.col("_fi") + 1, F.col("_fi") + reach))).join(goal, "_ti").select("_from", "_to", (F.col("_tu") - F.col("_fu")).alias("_gap"))
        halo = tail.join(F.broadcast(hops), F.col("_range") == F.col("_from")).where(F.col("_back") + F.col("_gap") <= reach)
        rows = rows.unionByName(halo.withColumns({"_range": F.col("_to"), "_own": F.lit(False)}).drop("_from", "_to", "_gap", "_back"))
    w = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(-reach, -shift)
    out = rows.withColumns({f"roll{n}_{c}": F.when(F.count(c).over(w) >= min_periods, F.avg(c).over(w)) for c in cols}).where("_own").drop("_range", "_own")
    return out.unionByName(rest.withColumns({f"roll{n}_{c}": F.lit(None).cast("double") for c in cols}))


def entity_profile(df: DataFrame, keys=("name", "team"), cols: list[str] | None = None) -> DataFrame:
    """Mean of every numeric column (or ``cols``) by entity."""
    cols = cols or [c for c in columns_like(df) if c not in keys]
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def first_role(df: DataFrame, keys=("name", "team"), order=("GW", "seq")) -> DataFrame:
    role = F.col("position")
    return df.groupBy(*keys).agg(F.min_by(role, F.when(role.isNotNull(), F.struct(*order))).alias("position"))


def latest_attributes(df: DataFrame, cols: list[str], keys=("name",), order=("GW", "seq")) -> DataFrame:
    """The latest value that is not missing, column by column."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in cols])


def map_group_mean(df: DataFrame, train: DataFrame, key: str, col: str, alias: str, train_key: str | None = None) -> DataFrame:
    """Mean of ``col`` by ``key`` in ``train``; unseen keys get the mean of the group means."""
    means = train.groupBy(F.col(train_key or key).alias("_k")).agg(F.avg(col).alias("_m")).where(F.col("_k").isNotNull())
    overall = means.agg(F.avg("_m").alias("_all"))
    return df.join(means, F.col(key) == F.col("_k"), "left").crossJoin(F.broadcast(overall)).withColumn(
        alias, F.coalesce("_m", "_all")).drop("_k", "_m", "_all")


def zscore(df: DataFrame, col: str, alias: str, train: DataFrame | None = None) -> DataFrame:
    """Standard score with mean and population deviation of ``train``; missing where the deviation is 0."""
    stats = (train if train is not None else df).agg(F.avg(col).alias("_mu"), F.stddev_pop(col).alias("_sd"))
    return df.crossJoin(F.broadcast(stats)).withColumn(alias, F.try_divide(F.col(col) - F.col("_mu"), F.col("_sd"))).drop("_mu", "_sd")


def role_baseline(df: DataFrame, target: str, fallback: dict | None = None, unseen: float = 0.05) -> DataFrame:
    """Mean target by role; roles without rows get the fallback, then ``unseen``."""
    means = df.where(F.col("position").isNotNull()).groupBy("position").agg(F.avg(target).alias("role_mean"))
    if fallback:
        spark = df.sparkSession
        table = spark.createDataFrame(list(fallback.items()), "position string, _f double")
        means = means.join(table, "position", "full").withColumn("role_mean", F.coalesce("role_mean", "_f", F.lit(unseen))).drop("_f")
    return means
