"""Squads under quotas and a budget. Every operator works on all scenarios of a key at once."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.scalars import hash_normal

# Fixed by the game.
SQUAD_QUOTA = {"GK": 2, "DEF": 5, "MID": 5, "FWD": 3}
FORMATIONS = [(d, m, f) for d in (3, 4, 5) for m in (2, 3, 4, 5) for f in (1, 2, 3) if d + m + f == 10]
BUDGET, CLUB_CAP = 100.0, 3


def _quota(role, quota: dict):
    out = F.lit(0)
    for r, n in quota.items():
        out = F.when(role == r, n).otherwise(out)
    return out


def quota_top_k(df: DataFrame, points: str = "ExpPts", quota: dict = SQUAD_QUOTA, club_cap: int | None = None, keys: tuple = ()) -> DataFrame:
    """Best ``quota`` of each role, after keeping the best ``club_cap`` of each team.

    The literal bound directly on the rank lets Spark cut each group before and after the shuffle.
    """
    best = [F.col(points).desc(), "name", "team"]
    if club_cap is not None:
        w = Window.partitionBy(*keys, "team").orderBy(*best)
        df = df.withColumn("_c", F.row_number().over(w)).where(F.col("_c") <= club_cap).drop("_c")
    w = Window.partitionBy(*keys, "position").orderBy(*best)
    top = df.withColumn("role_rank", F.row_number().over(w)).where(F.col("role_rank") <= max(quota.values()))
    return top.where(F.col("role_rank") <= _quota(F.col("position"), quota))


def shortfall(picked: DataFrame, quota: dict = SQUAD_QUOTA, keys: tuple = ()) -> DataFrame:
    """Roles that are short of their quota: missing."""
    want = picked.select(*keys).distinct() if keys else picked.sparkSession.range(1).drop("id")
    want = want.select(*keys, F.explode(F.array(*[F.struct(F.lit(r).alias("position"), F.lit(n).alias("quota")) for r, n in quota.items()])).alias("x")).select(*keys, "x.*")
    have = picked.groupBy(*keys, "position").agg(F.count("*").alias("n"))
    return want.join(have, [*keys, "position"], "left").withColumn("missing", F.col("quota") - F.coalesce("n", F.lit(0))).where(
        F.col("missing") > 0).drop("n")


def best_xi(squad: DataFrame, points: str = "ExpPts", keys: tuple = ("squad",)) -> DataFrame:
    """Squad rows with XI = 1 for the best legal eleven: prefix sums of each role against all legal formations."""
    best = [F.col(points).desc(), "name", "team"]
    ranked = squad.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "position").orderBy(*best)))
    sums = ranked.withColumn("_s", F.sum(points).over(Window.partitionBy(*keys, "position").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)))
    per = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws(":", "position", F.col("_r").cast("string")), F.col("_s").cast("double")))).alias("m"))
    value = lambda d, m, f: F.try_element_at("m", F.lit("GK:1")) + F.try_element_at("m", F.lit(f"DEF:{d}")) + F.try_element_at(
        "m", F.lit(f"MID:{m}")) + F.try_element_at("m", F.lit(f"FWD:{f}"))
    options = F.array_compact(F.array(*[F.when(value(*x).isNotNull(), F.struct(
        F.round(value(*x), 9).alias("v"), F.lit(-i).alias("o"), F.lit(x[0]).alias("DEF"), F.lit(x[1]).alias("MID"), F.lit(x[2]).alias("FWD")))
        for i, x in enumerate(FORMATIONS)]))
    chosen = per.select(*keys, F.array_max(options).alias("_f"))
    out = ranked.join(chosen, list(keys), "left") if keys else ranked.crossJoin(chosen)
    n = F.when(F.col("position") == "GK", 1).when(F.col("position") == "DEF", F.col("_f.DEF")).when(
        F.col("position") == "MID", F.col("_f.MID")).when(F.col("position") == "FWD", F.col("_f.FWD"))
    return out.withColumn("XI", F.coalesce((F.col("_r") <= n).cast("int"), F.lit(0))).drop("_r", "_f")


def audit(squad: DataFrame, keys: tuple = ("squad",), budget: float = BUDGET, quota: dict = SQUAD_QUOTA, club_cap: int = CLUB_CAP) -> DataFrame:
    """One row for each rule that a squad breaks: rule and the value found."""
    xi, role = F.col("XI") == 1, F.col("position")
    agg = squad.groupBy(*keys).agg(
        F.count("*").alias("size"), F.count_if(xi).alias("xi_size"), F.round(F.sum("price"), 6).alias("budget"),
        *[F.count_if(role == r).alias(f"quota_{r}") for r in quota],
        F.count_if(xi & (role == "GK")).alias("xi_GK"), F.count_if(xi & (role == "DEF")).alias("xi_DEF"),
        F.count_if(xi & (role == "MID")).alias("xi_MID"), F.count_if(xi & (role == "FWD")).alias("xi_FWD"))
    clubs = squad.groupBy(*keys, "team").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max("n").alias("club_cap"))
    agg = agg.join(clubs, list(keys))
    total = sum(quota.values())
    rules = {"size": F.col("size") != total, "xi_size": F.col("xi_size") != 11, "budget": F.col("budget") > budget,
             **{f"quota_{r}": F.col(f"quota_{r}") != n for r, n in quota.items()},
             "xi_GK": F.col("xi_GK") != 1, "xi_DEF": F.col("xi_DEF") < 3, "xi_MID": F.col("xi_MID") < 2, "xi_FWD": F.col("xi_FWD") < 1,
             "club_cap": F.col("club_cap") > club_cap}
    broken = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(r).alias("rule"), F.col(r).cast("double").alias("found"))) for r, bad in rules.items()]))
    return agg.select(*keys, F.explode(broken).alias("x")).select(*keys, "x.*")


def noise_levels(df: DataFrame, levels: list[int], seed: int = 42, points: str = "ExpPts", unit: float = 0.01) -> DataFrame:
    """A scenario for each level k: points plus unit * k * z, one draw z for each player."""
    z = hash_normal(F.col("name"), F.col("team"), seed=seed)
    return df.withColumn("_z", z).withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]))).withColumn(
        points, F.round(F.col(points) + F.col("level") * unit * F.col("_z"), 6)).drop("_z")


def stability(picked: DataFrame, levels: int, base: int = 0) -> DataFrame:
    """For each player the share of scenarios that pick it, and whether the base scenario does."""
    return picked.groupBy("name", "team").agg(
        (F.count("*") / F.lit(float(levels))).alias("share"), F.max((F.col("level") == base).cast("int")).alias("in_base"))


def squad_output(squad: DataFrame, only_xi: bool = False) -> DataFrame:
    out = squad.where("XI = 1") if only_xi else squad
    return out.orderBy(F.col("XI").desc(), "position", F.col("ExpPts").desc(), "name", "team")


def price_check(df: DataFrame, lo: float, hi: float) -> DataFrame:
    """Counts of implausible prices by cause."""
    cause = F.when(F.col("price").isNull(), "missing").when(F.col("price") < lo, "low").when(F.col("price") > hi, "high")
    return df.select(cause.alias("cause")).where("cause is not null").groupBy("cause").agg(F.count("*").alias("n"))


def useful_candidates(df: DataFrame, keys: tuple, quota: dict = SQUAD_QUOTA, club_cap: int | None = CLUB_CAP, points: str = "ExpPts") -> DataFrame:
    """Candidates that some best squad may need: in any squad a lower-ranked pick of a cell can be swapped for a better
    one of the same team, role and price, so the best min(cap, quota) of each cell are enough."""
    cell = [*keys, "team", "position", "price"] if club_cap else [*keys, "position", "price"]
    r = F.row_number().over(Window.partitionBy(*cell).orderBy(F.col(points).desc(), "name"))
    top = max(quota.values()) if club_cap is None else min(club_cap, max(quota.values()))
    need = _quota(F.col("position"), quota) if club_cap is None else F.least(F.lit(club_cap), _quota(F.col("position"), quota))
    return df.withColumn("_r", r).where(F.col("_r") <= top).where(F.col("_r") <= need).drop("_r")


def fillable(df: DataFrame, keys: tuple, quota: dict = SQUAD_QUOTA, club_cap: int = CLUB_CAP) -> DataFrame:
    """keys, ok: whether any squad keeps quotas and club cap, whatever its price.

    One exists if and only if for every set of roles the clubs, each giving at most ``club_cap`` of the set's players, can
    fill the set's quotas together (the cuts of the flow from roles to clubs).
    """
    n = df.groupBy(*keys, "team").agg(*[F.count_if(F.col("position") == r).alias(f"_n_{r}") for r in quota])
    sets = [c for k in range(1, len(quota) + 1) for c in combinations(quota, k)]
    room = n.groupBy(*keys).agg(*[F.sum(F.least(sum((F.col(f"_n_{r}") for r in c), F.lit(0)), F.lit(club_cap))).alias(f"_s{i}") for i, c in enumerate(sets)])
    ok = F.lit(True)
    for i, c in enumerate(sets):
        ok = ok & (F.col(f"_s{i}") >= sum(quota[r] for r in c))
    return room.select(*keys, ok.alias("ok"))


def priced_squads(df: DataFrame, keys: tuple, multipliers: tuple, quota: dict = SQUAD_QUOTA, club_cap: int = CLUB_CAP,
                  points: str = "ExpPts") -> DataFrame:
    """Squads for each scenario, price multiplier, formation and order of the roles: starters by points less price times
    multiplier, then the cheapest bench, under quotas and club cap; multiplier infinity goes by price alone.

    The roles are filled one after the other, each with its best players whose club has room. ``formation`` numbers the
    (formation, order); squads that cannot be completed in their order are left out.
    """
    inf = float("inf")
    rows = df.select(*keys, "name", "team", "position", "price", points).dropna(subset=["price", points])
    rows = rows.withColumn("lam", F.explode(F.array(*[F.lit(float(x)) for x in multipliers])))
    rows = rows.withColumn("score", F.when(F.col("lam") == inf, -F.col("price")).otherwise(F.col(points) - F.col("lam") * F.col("price")))
    # of a team and role no squad needs more than the cap's best of either kind; of a role, at most the squad's size may
    # be picked already and as many be of full clubs
    total, names = sum(quota.values()), [c for c in rows.columns if c != "score"]
    by = {"_a": [F.col("score").desc(), "price", "name"], "_b": ["price", F.col(points).desc(), "name"]}
    for part, most in (("team", club_cap), (None, 2 * total)):
        cell = [*keys, "lam", "position", *([part] if part else [])]
        for c, order in by.items():
            # the second rank counts only rows that the first kept for the same order
            w = Window.partitionBy(*cell, *([] if part else [F.col(f"{c}_in")])).orderBy(*order, "team")
            rows = rows.withColumn(c, F.row_number().over(w) <= most)
            if not part:
                rows = rows.withColumn(c, F.col(c) & F.col(f"{c}_in"))
        rows = rows.where("_a OR _b").withColumnsRenamed({"_a": "_a_in", "_b": "_b_in"})
    player = F.struct("name", "team", "position", "price", F.col(points).alias("points"))
    lists = rows.groupBy(*keys, "lam").agg(  # at most four times the squad's size of each role
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), F.col("price").alias("o2"), player.alias("p")))).alias("_best"),
        F.sort_array(F.collect_list(F.struct(F.col("price").alias("o"), (-F.col(points)).alias("o2"), player.alias("p")))).alias("_cheap"))
    steps, names_ = [], tuple(quota)
    for i, f in enumerate(FORMATIONS):
        first = dict(zip(("GK", "DEF", "MID", "FWD"), (1, *f)))
        if all(quota.get(r, 0) >= n for r, n in first.items()):
            for j, order in enumerate(permutations(names_)):
                slots = [(r, s, n) for s in (True, False) for r in order if (n := first.get(r, 0) if s else quota[r] - first.get(r, 0))]
                steps.append(F.struct(F.lit(100 * i + j).alias("formation"), F.array(*[F.struct(F.lit(r).alias("r"), F.lit(s).alias("first"), F.lit(n).alias("n")) for r, s, n in slots]).alias("slots")))
    tried = lists.withColumn("_v", F.explode(F.array(*steps))).select("*", "_v.formation", "_v.slots").drop("_v")
    none = F.slice(F.transform("_best", lambda x: x["p"]), 1, 0)

    def take(state, x):
        p = x["p"]
        same = lambda q: q["team"].eqNullSafe(p["team"])
        fits = (state["left"] > 0) & (F.size(F.filter(state["picks"], same)) < club_cap) & ~F.exists(
            state["picks"], lambda q: same(q) & q["name"].eqNullSafe(p["name"]) & (q["position"] == p["position"]) & (q["price"] == p["price"]))
        return F.when(fits, F.struct(F.concat(state["picks"], F.array(p)).alias("picks"), (state["left"] - 1).alias("left"))).otherwise(state)

    def fill(picks, slot):
        of = lambda c: F.filter(c, lambda x: x["p"]["position"] == slot["r"])
        from_ = F.when(slot["first"], of("_best")).otherwise(of("_cheap"))
        return F.aggregate(from_, F.struct(picks.alias("picks"), slot["n"].alias("left")), take)["picks"]

    squads = tried.select(*keys, "lam", "formation", F.aggregate("slots", none, fill).alias("_p")).where(F.size("_p") == total)
    return squads.select(*keys, F.explode("_p").alias("p"), "lam", "formation").select(
        *keys, "p.name", "p.team", "p.position", "p.price", F.col("p.points").alias(points), "lam", "formation").select(*names, "formation")


def squad_search(df: DataFrame, keys: tuple, multipliers=(0.0, 0.1, 0.2, 0.4, 0.8), budget: float = BUDGET, quota: dict = SQUAD_QUOTA,
                 club_cap: int = CLUB_CAP, points: str = "ExpPts") -> DataFrame:
    """One row for each scenario (``keys``): status, value and bound of the eleven's points, gap, and the chosen squad.

    A heuristic: for each price multiplier, legal formation and order of the roles the squad with the best starters by
    points less price times multiplier and the cheapest bench, filled role by role under quotas and club cap
    (``priced_squads``); its eleven is then chosen exactly, and the best squad within the budget kept. The quotas filled by
    priced points from each club's best, and the squads that go by price alone, are tried too. Status "none", with null
    value, says that no squad is legal: no squad keeps quotas and club cap (``fillable``), or even the cheapest players of each
    role cost more than the budget. Status "not found" says that none was found. The
    bound drops the club cap and lets the bench be chosen apart: for each multiplier the best starters' points less
    their priced cost, less the priced cost of the cheapest bench, plus the priced budget; the least over the
    multipliers.
    """
    pool = useful_candidates(df, keys, quota, club_cap, points)
    lam = F.explode(F.array(*[F.lit(float(x)) for x in multipliers]))
    picked = priced_squads(pool, keys, (*multipliers, float("inf")), quota, club_cap, points)
    # the fifteen best by priced points, which may leave a better eleven where the best starters are over the budget
    best = pool.withColumn("lam", lam).withColumn("score", F.col(points) - F.col("lam") * F.col("price"))
    best = quota_top_k(best, "score", quota, club_cap, (*keys, "lam")).withColumn("formation", F.lit(-1))
    squads = best_xi(picked.unionByName(best.select(*picked.columns)), points, (*keys, "lam", "formation"))
    value = squads.groupBy(*keys, "lam", "formation").agg(
        F.round(F.sum(F.when(F.col("XI") == 1, F.col(points))), 6).alias("value"), F.round(F.sum("price"), 6).alias("cost"), F.count("*").alias("n"),
        F.count_if(F.col("XI") == 1).alias("xi"),
        F.array_sort(F.collect_list(F.struct("position", "name", "team", "XI"))).alias("squad"))
    good = value.where((F.col("cost") <= budget) & (F.col("n") == sum(quota.values())) & (F.col("xi") == 11))
    best = good.groupBy(*keys).agg(F.max_by(F.struct("value", "cost", "lam", "squad"), F.struct("value", -F.col("cost"), -F.col("lam"), -F.col("formation"))).alias("b"))
    # bound, from all candidates: prefix sums of priced points and of the cheapest prices by role
    full = df.withColumn("lam", lam).withColumn("gain", F.col(points) - F.col("lam") * F.col("price"))
    w = lambda *o: Window.partitionBy(*keys, "lam", "position").orderBy(*o)
    top = max(quota.values())
    gains = full.withColumn("r", F.row_number().over(w(F.col("gain").desc(), "name", "team"))).where(F.col("r") <= top)
    costs = full.withColumn("r", F.row_number().over(w("price", "name", "team"))).where(F.col("r") <= top)
    maps = gains.groupBy(*keys, "lam").agg(F.collect_list(F.struct("position", "r", "gain")).alias("g")).join(
        costs.groupBy(*keys, "lam").agg(F.collect_list(F.struct("position", "r", "price")).alias("c")), [*keys, "lam"])
    part = lambda arr, field, role, n: F.aggregate(F.filter(arr, lambda x: (x["position"] == role) & (x["r"] <= n)), F.lit(0.0), lambda a, x: a + x[field])
    bounds = [sum((part("g", "gain", r, n) - F.col("lam") * part("c", "price", r, quota[r] - n) for r, n in zip(("GK", "DEF", "MID", "FWD"), (1, *f))), F.lit(0.0))
              for f in FORMATIONS]
    bound = maps.select(*keys, (F.greatest(*bounds) + F.col("lam") * budget).alias("v")).groupBy(*keys).agg(F.round(F.min("v"), 6).alias("bound"))
    cheapest = Window.partitionBy(*keys, "position").orderBy("price", "name", "team")
    least = pool.withColumn("_r", F.row_number().over(cheapest)).where(F.col("_r") <= max(quota.values())).where(F.col("_r") <= _quota(F.col("position"), quota))
    least = least.groupBy(*keys).agg(F.sum("price").alias("_least"))
    can = fillable(df.dropna(subset=["price", points]), keys, quota, club_cap)
    out = df.select(*keys).distinct()
    for part in (best, bound, least, can):
        out = out.join(part, list(keys), "left")
    legal = F.coalesce(F.col("ok"), F.lit(False)) & F.coalesce(F.col("_least") <= budget + 1e-9, F.lit(False))
    status = F.when(F.col("b").isNotNull(), "feasible").when(legal, "not found").otherwise("none")
    return out.select(*keys, status.alias("status"), F.col("b.value").alias("value"),
                      "bound", F.round(F.col("bound") - F.col("b.value"), 6).alias("gap"), F.col("b.cost").alias("cost"), F.col("b.lam").alias("lam"), F.col("b.squad").alias("squad"))
