"""Queries: cleaning, schedules, strengths, group means, profiles, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import clean, features, merge
from panelkit.plans.catalogue import query
from panelkit.plans.views import fixtures, panel, teams

_AS_OF = "2024-01-18 12:00:00"
_FIRST = """sides AS (
  SELECT GW, seq, team_h AS team, team_a AS opp, true AS home FROM v_fixtures UNION ALL SELECT GW, seq, team_a, team_h, false FROM v_fixtures),
fx AS (SELECT GW, team, arg_min(opp, seq) AS opp, arg_min(home, seq) AS home FROM sides GROUP BY GW, team)"""


def _strength_sql(kind: str, home: str, opp: str, src: str, same: bool) -> str:
    other = {"attack": "defence", "defence": "attack"}[kind]
    h = f"coalesce({home}, true)"
    o = h if same else f"NOT {h}"
    return f"""SELECT *, (own_k - opp_k + own_o - opp_o) / 100.0 AS fixture_difficulty FROM (
  SELECT p.*, coalesce(CASE WHEN {h} THEN a.{kind}_home ELSE a.{kind}_away END, 1100) AS own_k,
    coalesce(CASE WHEN {h} THEN a.overall_home ELSE a.overall_away END, 1100) AS own_o,
    coalesce(CASE WHEN NOT {h} THEN b.{other}_home ELSE b.{other}_away END, 1100) AS opp_k,
    coalesce(CASE WHEN {o} THEN b.overall_home ELSE b.overall_away END, 1100) AS opp_o
  FROM {src} p LEFT JOIN v_teams a ON a.name = p.team LEFT JOIN v_teams b ON b.id = p.{opp})"""


@query("B1 D17 A5", "rows:int numbers:int missing:int lo:num hi:num first_gw:int last_gw:int", """
  SELECT count(*) AS rows, count(x) AS numbers, count(*) - count(x) AS missing, min(x) AS lo, max(x) AS hi, min(GW) AS first_gw, max(GW) AS last_gw
  FROM (SELECT GW, CASE WHEN seq % 13 = 0 THEN NULL ELSE threat END AS x FROM v_panel)""")
def coerce_profile(spark, sf):
    raw = panel(spark, sf).withColumn("x", F.when(F.col("seq") % 13 == 0, "n/a").otherwise(F.col("threat").cast("string")))
    x = F.col("x")
    return clean.coerce_numeric(raw, ["x"]).agg(
        F.count("*").alias("rows"), F.count(x).alias("numbers"), F.count_if(x.isNull()).alias("missing"), F.min(x).alias("lo"),
        F.max(x).alias("hi"), F.min("GW").alias("first_gw"), F.max("GW").alias("last_gw"))


@query("B2", "seq:int home:int", "SELECT seq, CASE home_text WHEN 'True' THEN 1 WHEN 'False' THEN 0 END AS home FROM v_panel")
def bool_flags(spark, sf):
    return panel(spark, sf).select("seq", S.flag(F.col("home_text")).alias("home"))


@query("B3", "seq:int GW:int", "SELECT seq, GW FROM v_panel WHERE GW BETWEEN 1 AND 20")
def period_slice(spark, sf):
    return clean.period_slice(panel(spark, sf), 1, 20)


@query("B4", "last_period:int next_period:int", f"""
  SELECT max(GW) AS last_period, max(GW) + 1 AS next_period FROM v_fixtures WHERE kickoff <= TIMESTAMP '{_AS_OF}'""")
def next_period(spark, sf):
    return clean.next_period(fixtures(spark, sf), F.lit(_AS_OF).cast("timestamp_ntz"))


@query("B5 B12 B13 B22", "seq:int name team opponent position minutes:num", """
  SELECT seq, p.name, team, position, minutes, t.name AS opponent FROM v_panel p JOIN v_teams t ON t.id = p.opponent_team
  WHERE position IN ('GK', 'DEF') AND minutes >= 60 AND team IN ('NATION_1', 'NATION_2', 'NATION_3')""")
def eligible_active(spark, sf):
    rows = clean.eligible(clean.drop_missing(panel(spark, sf), ["opponent_team"]), ["GK", "DEF"], 60)
    rows = clean.filter_members(rows, "team", ["NATION_1", "NATION_2", "NATION_3"])
    return clean.active_only(clean.lookup_name(rows, teams(spark, sf), "opponent_team", "opponent"), 30)


@query("B6 B7 B15 B21 B25", "seq:int code_role is_DEF:int is_FWD:int venue card:int period:int", """
  SELECT seq, CASE element_type WHEN 1 THEN 'GK' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' END AS code_role,
    coalesce((position = 'DEF')::INT, 0) AS "is_DEF", coalesce((position = 'FWD')::INT, 0) AS "is_FWD",
    concat(coalesce(t.name, 'Unknown'), CASE WHEN was_home THEN '(H)' ELSE '(A)' END) AS venue, coalesce((yellow_cards + red_cards > 0)::INT, 0) AS card, 31 AS period
  FROM v_panel p LEFT JOIN v_teams t ON t.id = p.opponent_team""")
def codes_and_labels(spark, sf):
    rows = clean.lookup_name(panel(spark, sf), teams(spark, sf), "opponent_team", "opponent")
    rows = clean.one_hot(rows, "position", {"is_DEF": "DEF", "is_FWD": "FWD"}).drop("GW")
    venue = F.concat("opponent", F.when(F.col("was_home"), "(H)").otherwise("(A)"))
    return clean.with_period(rows, 31).select("seq", clean.map_codes(F.col("element_type")).alias("code_role"), "is_DEF", "is_FWD",
                                              venue.alias("venue"), S.any_event(F.col("yellow_cards"), F.col("red_cards")).alias("card"), F.col("GW").alias("period"))


@query("B8", "seq:int opponent", "SELECT seq, coalesce(t.name, 'Unknown') AS opponent FROM v_panel p LEFT JOIN v_teams t ON t.id = p.opponent_team")
def lookup_names(spark, sf):
    return clean.lookup_name(panel(spark, sf), teams(spark, sf), "opponent_team", "opponent")


@query("B9 M15 B26 B23", "seq:int feature value:num", """
  SELECT seq, feature, value FROM (SELECT seq, threat::DOUBLE AS threat, minutes::DOUBLE AS minutes, roll3_minutes FROM (
    SELECT *, avg(minutes) OVER (PARTITION BY name ORDER BY GW, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll3_minutes FROM v_panel))
  UNPIVOT (value FOR feature IN (threat, minutes, roll3_minutes))""")
def available_features(spark, sf):
    from panelkit.operators.models import feature_list

    rows = clean.harmonise(features.rolling_mean(panel(spark, sf), ["minutes"]), {"threat": "threat_raw"})
    rows = clean.harmonise(rows, {"threat_raw": "threat"})
    names = feature_list(rows, ["threat", "minutes", "no_such_column"], {"rolled": clean.columns_like(rows, "roll3_")[0]})
    return rows.select("seq", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in names])).alias("x")).select("seq", "x.*")


@query("B10 B11 B14", "seq:int yellow:int extra:num role price:num", """
  SELECT seq, coalesce(yellow_cards, 0) AS yellow, 0.5 AS extra, coalesce(position, 'MID') AS role, value_tenths / 10.0 AS price FROM v_panel""")
def defaults_and_price(spark, sf):
    rows = clean.fill_defaults(panel(spark, sf), {"yellow_cards": 0, "extra": 0.5})
    return rows.select("seq", F.col("yellow_cards").alias("yellow"), "extra", clean.first_present(rows, ["no_role", "position"], "MID").alias("role"),
                       (F.col("value_tenths") / 10.0).alias("price"))


@query("B16 B17", "seq:int even:num low:num both:num", """
  SELECT seq, round_even(expected_goals_conceded, 2) AS even, CASE WHEN yellow_cards IS NOT NULL THEN greatest(yellow_cards::DOUBLE, 0.5) END AS low,
    least(greatest(threat, 10.0), 50.0) AS both FROM v_panel""")
def half_even_and_clip(spark, sf):
    return panel(spark, sf).select("seq", S.half_even(F.col("expected_goals_conceded"), 2).alias("even"),
                                   S.clip(F.col("yellow_cards").cast("double"), lo=0.5).alias("low"), S.clip(F.col("threat"), 10.0, 50.0).alias("both"))


@query("C1", "seq:int own:int opp:int fixture_difficulty:num", "WITH r0 AS (" + _strength_sql("attack", "was_home", "opponent_team", "v_panel", False) + """),
r AS (SELECT seq, own_k AS own, opp_k AS opp, fixture_difficulty FROM r0)""")
def strength_join(spark, sf):
    return features.enrich_strength(panel(spark, sf), teams(spark, sf)).select(
        "seq", F.col("team_attack").alias("own"), F.col("opp_defence").alias("opp"), "fixture_difficulty")


@query("C2", "seq:int own:int opp:int fixture_difficulty:num", "WITH r0 AS (" + _strength_sql("defence", "was_home", "opponent_team", "v_panel", True) + """),
r AS (SELECT seq, own_k AS own, opp_k AS opp, fixture_difficulty FROM r0)""")
def strength_join_def(spark, sf):
    return features.enrich_strength(panel(spark, sf), teams(spark, sf), "defence").select(
        "seq", F.col("team_defence").alias("own"), F.col("opp_attack").alias("opp"), "fixture_difficulty")


@query("C3 E3", "seq:int opp_id:int opponent at_home:flag", f"""WITH {_FIRST}, r AS (
  SELECT p.seq, fx.opp AS opp_id, coalesce(t.name, 'Unknown') AS opponent, coalesce(fx.home, false) AS at_home
  FROM v_panel p LEFT JOIN fx ON fx.GW = p.GW AND fx.team = p.team_id LEFT JOIN v_teams t ON t.id = fx.opp)""")
def fixture_attach(spark, sf):
    return features.attach_fixture(panel(spark, sf), fixtures(spark, sf), teams(spark, sf))


@query("C4 D2", "name team GW:int avg_minutes:num avg_threat:num", """
  SELECT d.name, d.team, 31 AS GW, avg_minutes, avg_threat FROM (SELECT DISTINCT name, team FROM v_panel WHERE GW >= 20) d
  LEFT JOIN (SELECT name, team, avg(minutes) AS avg_minutes, avg(threat) AS avg_threat FROM v_panel GROUP BY ALL) m ON m.name = d.name AND m.team = d.team""")
def attach_profile(spark, sf):
    p = panel(spark, sf)
    names = clean.with_period(p.where("GW >= 20").select("name", "team").distinct(), 31)
    prof = features.entity_profile(p, cols=["minutes", "threat"]).withColumnsRenamed({"minutes": "avg_minutes", "threat": "avg_threat"})
    return names.join(prof, ["name", "team"], "left")


@query("D2", "name team minutes:num threat:num bps:num yellow_cards:num", """
  SELECT name, team, avg(minutes) AS minutes, avg(threat) AS threat, avg(bps) AS bps, avg(yellow_cards) AS yellow_cards FROM v_panel GROUP BY name, team""")
def entity_profile(spark, sf):
    return features.entity_profile(panel(spark, sf))


@query("C5 D3", "name team position", """
  SELECT name, team, arg_min(position, (GW, seq)) FILTER (position IS NOT NULL) AS position FROM v_panel GROUP BY name, team""")
def first_role(spark, sf):
    p = panel(spark, sf)
    return p.select("name", "team").distinct().join(features.first_role(p), ["name", "team"], "left")


@query("D4 C13", "name team position value_tenths:int", """
  SELECT name, arg_max(team, (GW, seq)) AS team, arg_max(position, (GW, seq)) FILTER (position IS NOT NULL) AS position,
    arg_max(value_tenths, (GW, seq)) AS value_tenths FROM v_panel GROUP BY name""")
def latest_attrs(spark, sf):
    return features.latest_attributes(panel(spark, sf), ["team", "position", "value_tenths"])


@query("C10 D5 D6", "seq:int team_rate:num opp_rate:num z:num", """WITH t AS (SELECT team, avg(clean_sheets) AS m FROM v_panel WHERE GW <= 15 AND seq % 5 <> 0 GROUP BY team),
o AS (SELECT opponent_team AS k, avg(clean_sheets) AS m FROM v_panel WHERE GW <= 15 AND opponent_team < 20 GROUP BY opponent_team),
s AS (SELECT avg(expected_goals_conceded) AS mu, stddev_pop(expected_goals_conceded) AS sd FROM v_panel WHERE GW <= 15),
r AS (SELECT seq, coalesce(t.m, (SELECT avg(m) FROM t)) AS team_rate, coalesce(o.m, (SELECT avg(m) FROM o)) AS opp_rate, (expected_goals_conceded - mu) / sd AS z
  FROM v_panel p LEFT JOIN t ON t.team = p.team LEFT JOIN o ON o.k = p.opponent_team CROSS JOIN s)""")
def target_mean_z(spark, sf):
    p = panel(spark, sf)
    train = p.where("GW <= 15")
    out = features.map_group_mean(p, train.where("seq % 5 <> 0"), "team", "clean_sheets", "team_rate")
    out = features.map_group_mean(out, train.where("opponent_team < 20"), "opponent_team", "clean_sheets", "opp_rate")
    return features.zscore(out, "expected_goals_conceded", "z", train)


@query("D1 M16", "position role_mean:num", "SELECT position, avg(goals_scored) AS role_mean FROM v_panel WHERE position IS NOT NULL GROUP BY position")
def role_baseline(spark, sf):
    return features.role_baseline(panel(spark, sf), "goals_scored", {"GK": 0.0, "DEF": 0.05, "MID": 0.1, "FWD": 0.2})


@query("D18", "seq:int yellow:num", "SELECT seq, coalesce(yellow_cards, (SELECT avg(yellow_cards) FROM v_panel)) AS yellow FROM v_panel")
def impute_mean(spark, sf):
    return clean.impute_means(panel(spark, sf), ["yellow_cards"]).withColumnRenamed("yellow_cards", "yellow")


def _rolling(shift: int) -> str:
    lo, hi = 2 + shift, f"{shift} PRECEDING" if shift else "CURRENT ROW"
    w = f"OVER (PARTITION BY name ORDER BY GW, seq ROWS BETWEEN {lo} PRECEDING AND {hi})"
    return f"SELECT seq, avg(minutes) {w} AS roll3_minutes, avg(yellow_cards) {w} AS roll3_yellow_cards FROM v_panel"


@query("E1", "seq:int roll3_minutes:num roll3_yellow_cards:num", _rolling(0))
def rolling3(spark, sf):
    return features.rolling_mean(panel(spark, sf), ["minutes", "yellow_cards"])


@query("E1", "seq:int roll3_minutes:num roll3_yellow_cards:num", _rolling(1))
def rolling3_shift(spark, sf):
    return features.rolling_mean(panel(spark, sf), ["minutes", "yellow_cards"], shift=1)


@query("E1", "seq:int roll3_minutes:num roll3_yellow_cards:num", _rolling(0))
def rolling3_ranged(spark, sf):
    return features.rolling_mean_ranged(panel(spark, sf), ["minutes", "yellow_cards"], ranges=16)


_BLEND = "WITH " + _FIRST + """,
prof AS (SELECT name, team, team_id, arg_min(position, (GW, seq)) FILTER (position IS NOT NULL) AS position, avg(minutes) AS minutes, avg(goals_scored) AS raw
  FROM v_panel WHERE GW <= 29 GROUP BY name, team, team_id),
base AS (SELECT position, avg(goals_scored) AS role_mean FROM v_panel WHERE GW <= 29 AND position IS NOT NULL GROUP BY position),
nxt AS (SELECT prof.*, fx.opp AS opp_id, fx.home AS at_home, coalesce(t.name, 'Unknown') AS opponent FROM prof LEFT JOIN fx ON fx.GW = 30 AND fx.team = prof.team_id
  LEFT JOIN v_teams t ON t.id = fx.opp),
st AS (""" + _strength_sql("attack", "at_home", "opp_id", "(SELECT name, team, position, minutes, raw, opp_id, coalesce(at_home, false) AS at_home, opponent FROM nxt)", False) + """),
adj AS (SELECT st.*, coalesce(role_mean, 0.05) AS role_mean, greatest(0.0, raw + (greatest(0.0, least(1.0, (fixture_difficulty + 5) / 10)) - 0.5)) AS adjusted,
  CASE position WHEN 'FWD' THEN 0.20 WHEN 'MID' THEN 0.12 WHEN 'DEF' THEN 0.06 WHEN 'GK' THEN 0.01 ELSE 0.10 END * greatest(0.2, least(1.0, coalesce(minutes, 0) / 60)) AS floor_
  FROM st LEFT JOIN base USING (position) WHERE opponent <> 'Unknown' AND minutes >= 30),
bl AS (SELECT name, team, position, opponent, fixture_difficulty, raw, adjusted, round_even(round(greatest(adjusted * 0.65 + role_mean * (1 - 0.65), floor_), 9), 2) AS prediction FROM adj)"""


def blended_predictions(spark, sf):
    """Next-period predictions of all active players: profile, fixture, strength, adjustment, blend and floor."""
    p = panel(spark, sf).where("GW <= 29")
    prof = features.entity_profile(p, ("name", "team", "team_id"), ["minutes", "goals_scored"]).withColumnRenamed("goals_scored", "raw")
    prof = prof.join(features.first_role(p, ("name", "team", "team_id")), ["name", "team", "team_id"])
    rows = features.attach_fixture(clean.with_period(prof, 30), fixtures(spark, sf), teams(spark, sf))
    rows = clean.active_only(features.enrich_strength(rows, teams(spark, sf), home="at_home", opponent="opp_id"))
    rows = rows.join(F.broadcast(features.role_baseline(p, "goals_scored")), "position", "left")  # a row for each role
    rows = rows.withColumn("adjusted", S.fixture_adjusted(F.col("raw"), F.col("fixture_difficulty")))
    return rows.withColumn("prediction", S.blended(
        F.col("adjusted"), F.coalesce("role_mean", F.lit(0.05)), S.role_floor(F.col("position"), F.col("minutes"))))


@query("D1 I1 I2 I3 F2", "name team position opponent fixture_difficulty:num prediction:num", _BLEND + """,
r AS (SELECT * FROM bl ORDER BY prediction DESC, name, team LIMIT 25)""")
def min_floor_blend(spark, sf):
    return blended_predictions(spark, sf).orderBy(F.col("prediction").desc(), "name", "team").limit(25)


@query("F1", "name team prediction:num", _BLEND + ", r AS (SELECT * FROM bl)")
def top_predictions(spark, sf):
    return blended_predictions(spark, sf).orderBy(F.col("prediction").desc(), "name", "team")


@query("D12 I2", "raw_slope:num raw_intercept:num adj_slope:num adj_intercept:num change_pct:num", _BLEND + """,
r0 AS (SELECT regr_slope(raw, fixture_difficulty) AS raw_slope, regr_intercept(raw, fixture_difficulty) AS raw_intercept,
  regr_slope(adjusted, fixture_difficulty) AS adj_slope, regr_intercept(adjusted, fixture_difficulty) AS adj_intercept FROM bl),
r AS (SELECT *, (adj_slope - raw_slope) / abs(raw_slope) * 100 AS change_pct FROM r0)""")
def trend_impact(spark, sf):
    from panelkit.operators.report import trend_impact as trend

    return trend(blended_predictions(spark, sf), "fixture_difficulty", "raw", "adjusted")


@query("A9 C9 G3", "GW:int", "SELECT x AS GW FROM generate_series(1, 35) g(x) WHERE x NOT IN (SELECT GW FROM v_panel WHERE GW % 4 <> 0)")
def period_gap(spark, sf):
    return merge.missing_periods(panel(spark, sf).where("GW % 4 <> 0"), 1, 35)


@query("A10 G1", "seq:int GW:int minutes:num marker:int", """
  SELECT seq, GW, minutes, NULL AS marker FROM v_panel WHERE GW % 4 <> 0 UNION ALL SELECT seq, GW, NULL, 1 FROM v_panel WHERE GW % 4 = 0""")
def append_union(spark, sf):
    p = panel(spark, sf)
    return merge.append_missing(p.where("GW % 4 <> 0").select("seq", "GW", "minutes"), p.select("seq", "GW", F.lit(1).alias("marker")))


@query("G2", "name team position", "SELECT DISTINCT name, team, position FROM v_panel")
def distinct_entities(spark, sf):
    return panel(spark, sf).select("name", "team", "position").distinct()


@query("G4", "team", "SELECT DISTINCT team FROM v_panel")
def distinct_members(spark, sf):
    return panel(spark, sf).select("team").distinct().orderBy("team")


