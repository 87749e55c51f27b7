"""Queries: merges, expected points, bins, ranks, key figures, odds."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import clean, merge, report
from panelkit.plans.catalogue import query
from panelkit.plans.q_features import _BLEND, blended_predictions
from panelkit.plans.views import fixtures, panel, table

_METRICS = {  # metric: panel column and the rows that have a prediction
    "goals": ("goals_scored", "element % 3 <> 0"), "assists": ("assists", "element % 4 <> 0"), "cs": ("clean_sheets", "element % 5 <> 0"),
    "card": ("red_cards", "element % 6 <> 0"), "bonus": ("bonus", "element % 7 <> 0")}
_METRIC_SQL = ", ".join(f"m_{m} AS (SELECT CASE WHEN element % 17 = 0 THEN NULL ELSE name END AS name, team, avg({c}) AS {m} FROM v_panel WHERE {w} GROUP BY ALL)" for m, (c, w) in _METRICS.items())
_KEYS_SQL = " UNION ".join(f"SELECT name, team FROM m_{m}" for m in _METRICS)
_JOIN_SQL = " ".join(f"LEFT JOIN m_{m} ON m_{m}.name IS NOT DISTINCT FROM k.name AND m_{m}.team IS NOT DISTINCT FROM k.team" for m in _METRICS)
_ROLE_SQL = "roles AS (SELECT name, team, arg_min(position, (GW, seq)) FILTER (position IS NOT NULL) AS position, avg(minutes) AS minutes, arg_max(value_tenths, (GW, seq)) / 10.0 AS price FROM v_panel GROUP BY name, team)"
_OUTER_SQL = f"""WITH {_METRIC_SQL}, {_ROLE_SQL}, mm AS (
  SELECT k.name, k.team, {", ".join(f"coalesce({m}, 0.0) AS {m}" for m in _METRICS)}, coalesce(position, 'MID') AS position, coalesce(minutes, 60.0) AS minutes
  FROM ({_KEYS_SQL}) k {_JOIN_SQL} LEFT JOIN roles ON roles.name = k.name AND roles.team = k.team),
tot AS (SELECT *, goals * (CASE position WHEN 'MID' THEN 5 ELSE 4 END) + assists * 3 + cs * (CASE WHEN position IN ('GK', 'DEF') THEN 4 ELSE 0 END)
  + (CASE WHEN minutes >= 60 THEN 2 ELSE 0 END) - card + bonus AS "ExpPts" FROM mm)"""


def metric_tables(spark, sf):
    p = panel(spark, sf)
    name = F.when(F.col("element") % 17 == 0, F.lit(None)).otherwise(F.col("name"))
    return [p.where(w).groupBy(name.alias("name"), "team").agg(F.avg(c).alias(m)) for m, (c, w) in _METRICS.items()]


def roles(spark, sf):
    """First role, mean minutes and latest price of each entity, in one aggregate."""
    order, role, tenths = F.struct("GW", "seq"), F.col("position"), F.col("value_tenths")
    return panel(spark, sf).groupBy("name", "team").agg(
        F.avg("minutes").alias("minutes"), F.min_by(role, F.when(role.isNotNull(), order)).alias("position"),
        (F.max_by(tenths, F.when(tenths.isNotNull(), order)) / 10.0).alias("price"))


def total_points(spark, sf):
    rows = merge.merge_metrics(metric_tables(spark, sf), ["name", "team"], {m: 0.0 for m in _METRICS})
    rows = clean.fill_defaults(rows.join(roles(spark, sf), ["name", "team"], "left"), {"position": "MID", "minutes": 60.0})
    return rows.withColumn("ExpPts", S.expected_points(F.col("position"), F.col("goals"), F.col("assists"), F.col("cs"), F.col("card"), F.col("bonus"), F.col("minutes")))


@query("C6 B10 I7", "name team goals:num assists:num cs:num card:num bonus:num ExpPts:num", _OUTER_SQL + ", r AS (SELECT * FROM tot)")
def outer_merge_points(spark, sf):
    return total_points(spark, sf)


@query("I10 F2", "name team ExpPts:num", _OUTER_SQL + """, r AS (SELECT name, team, round("ExpPts", 6) AS "ExpPts" FROM tot WHERE team <> 'NATION_3' ORDER BY round("ExpPts", 6) DESC, name NULLS FIRST, team LIMIT 25)""")
def total_points_report(spark, sf):
    rows = total_points(spark, sf).where("team <> 'NATION_3'").withColumn("ExpPts", F.round("ExpPts", 6))
    return rows.orderBy(F.col("ExpPts").desc(), F.col("name").asc_nulls_first(), "team").limit(25)


_LEFT_SQL = f"""WITH {_METRIC_SQL}, {_ROLE_SQL}, lm AS (
  SELECT g.name, g.team, goals, coalesce(assists, 0.0) AS assists, coalesce(cs, 0.0) AS cs, coalesce(card, 0.0) AS card, position, price
  FROM m_goals g LEFT JOIN m_assists a ON a.name = g.name AND a.team = g.team
  LEFT JOIN (SELECT name, max(cs) AS cs FROM m_cs GROUP BY name) c ON c.name = g.name
  LEFT JOIN m_card d ON d.name = g.name AND d.team = g.team JOIN roles ON roles.name = g.name AND roles.team = g.team WHERE price IS NOT NULL),
sel AS (SELECT name, team, position, price, round(goals * (CASE position WHEN 'MID' THEN 5 ELSE 4 END) + assists * 3
  + cs * (CASE WHEN position IN ('GK', 'DEF') THEN 4 ELSE 0 END) - card, 6) AS "ExpPts" FROM lm)"""


def selection_pool(spark, sf):
    """name, team, position, price and the selection form of expected points."""
    goals, assists, cs, card, _ = metric_tables(spark, sf)
    rows = merge.attach_metric(goals, assists, "assists", ["name", "team"], 0.0)
    rows = merge.attach_metric(rows, cs, "cs", ["name"], 0.0, single=True)
    rows = merge.attach_metric(rows, card, "card", ["name", "team"], 0.0)
    rows = clean.drop_missing(rows.join(roles(spark, sf), ["name", "team"]), ["price"])
    return rows.select("name", "team", "position", "price", F.round(S.expected_points(
        F.col("position"), F.col("goals"), F.col("assists"), F.col("cs"), F.col("card")), 6).alias("ExpPts"))


@query("C7 C13 B11 I8", "name team position price:num ExpPts:num", _LEFT_SQL + ", r AS (SELECT * FROM sel)")
def left_merge_points(spark, sf):
    return selection_pool(spark, sf)


@query("D7 I4", "seq:int card:num", """WITH q AS (SELECT quantile_cont(influence, 0.99) AS q FROM v_panel),
r AS (SELECT seq, round_even(round(least(greatest(influence / q * 0.35, 0.0), 0.35), 9), 2) AS card FROM v_panel, q)""")
def p99_scale(spark, sf):
    return report.percentile_scaled(panel(spark, sf), "influence", "card")


@query("I5", "seq:int prob:num", """
  SELECT seq, round_even(round(least(greatest(1 / (1 + exp(-(1.7 * influence / 10 - 1.0))), 0.0), 0.5), 9), 2) AS prob FROM v_panel""")
def calibrated_cap(spark, sf):
    p = 1 / (1 + F.exp(-(F.lit(1.7) * F.col("influence") / 10 - 1.0)))
    return panel(spark, sf).select("seq", S.half_even(S.clip(p, 0.0, 0.5), 2).alias("prob"))


@query("I6", "seq:int goals:num", "SELECT seq, greatest(goals_scored / 100.0, 0.001) AS goals FROM v_panel")
def small_floor(spark, sf):
    return panel(spark, sf).select("seq", S.clip(F.col("goals_scored") / 100.0, lo=0.001).alias("goals"))


@query("I1", "seq:int floor:num", """
  SELECT seq, CASE position WHEN 'FWD' THEN 0.20 WHEN 'MID' THEN 0.12 WHEN 'DEF' THEN 0.06 WHEN 'GK' THEN 0.01 ELSE 0.10 END
    * greatest(0.2, least(1.0, coalesce(minutes, 0) / 60)) AS floor FROM v_panel""")
def role_floors(spark, sf):
    return panel(spark, sf).select("seq", S.role_floor(F.col("position"), F.col("minutes")).alias("floor"))


_EDGES = [0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]


@query("D9", "bin:int lo:num hi:num n:int", """WITH e AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(_EDGES, _EDGES[1:]))) + """) t(bin, lo, hi)),
r AS (SELECT bin, lo, hi, (SELECT count(*) FROM v_panel WHERE (influence > lo OR (bin = 0 AND influence = lo)) AND influence <= hi) AS n FROM e)""")
def bins_explicit(spark, sf):
    return report.bin_counts(panel(spark, sf), "influence", _EDGES, include_lowest=True)


_EQUAL = """WITH b AS (SELECT min({x}) AS lo, max({x}) AS hi FROM {t}),
k AS (SELECT CAST(coalesce(least({n}, greatest(1, {f})), 1) AS INT) AS bin FROM {t}, b WHERE {x} IS NOT NULL),
r AS (SELECT i AS bin, round(lo + (hi - lo) / {n} * (i - 1) - CASE WHEN i = 1 THEN (hi - lo) * {slack} ELSE 0 END, 6) AS lo, round(lo + (hi - lo) / {n} * i, 6) AS hi,
  (SELECT count(*) FROM k WHERE k.bin = i) AS n FROM b, generate_series(1, {n}) g(i))"""


@query("D10", "bin:int lo:num hi:num n:int", _EQUAL.format(t="part", x="p_retailprice", n=10, f="ceil((p_retailprice - lo) / ((hi - lo) / 10))", slack=0.001))
def bins_equal(spark, sf):
    return report.equal_width_counts(table(spark, sf, "part"), "p_retailprice", 10)


@query("D11", "series bin:int n:int", """WITH b AS (SELECT min(l_tax) AS t0, max(l_tax) AS t1, min(l_discount) AS d0, max(l_discount) AS d1 FROM lineitem),
k AS (SELECT 'raw' AS series, least(20, floor((l_tax - t0) / ((t1 - t0) / 20)) + 1) AS bin FROM lineitem, b UNION ALL
  SELECT 'adjusted', least(20, floor((l_discount - d0) / ((d1 - d0) / 20)) + 1) FROM lineitem, b),
r AS (SELECT s.series, i AS bin, (SELECT count(*) FROM k WHERE k.series = s.series AND k.bin = i) AS n
  FROM (VALUES ('raw'), ('adjusted')) s(series), generate_series(1, 20) g(i))""")
def hist20(spark, sf):
    rows = table(spark, sf, "lineitem")
    one = lambda c, n: report.equal_width_counts(rows, c, 20, "left").select(F.lit(n).alias("series"), "bin", "n")
    return one("l_tax", "raw").union(one("l_discount", "adjusted"))


@query("I9 F2", "venue name:text prediction:num", _BLEND + """,
r AS (SELECT concat(opponent, '(', CASE WHEN fixture_difficulty > 0 THEN 'H' ELSE 'A' END, ')') AS venue, name, prediction FROM bl
  WHERE team IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5') ORDER BY prediction DESC, name, team LIMIT 25)""")
def metric_report(spark, sf):
    rows = clean.filter_members(blended_predictions(spark, sf), "team", [f"NATION_{i}" for i in range(1, 6)])
    top = rows.orderBy(F.col("prediction").desc(), "name", "team").limit(25)
    return top.withColumn("venue", F.concat("opponent", F.when(F.col("fixture_difficulty") > 0, "(H)").otherwise("(A)")))


@query("F3", "side name team fixture_difficulty:num", _BLEND + """,
r AS (SELECT * FROM (SELECT 'low' AS side, name, team, fixture_difficulty FROM bl ORDER BY round(fixture_difficulty, 6), name, team LIMIT 5)
  UNION ALL SELECT * FROM (SELECT 'high', name, team, fixture_difficulty FROM bl ORDER BY round(fixture_difficulty, 6) DESC, name, team LIMIT 5))""")
def extremes(spark, sf):
    rows = blended_predictions(spark, sf).withColumn("fixture_difficulty", F.round("fixture_difficulty", 6))
    return report.extremes(rows, "fixture_difficulty", 5, ["name", "team"])


@query("D8", "team best:num", _BLEND + ", r AS (SELECT team, max(prediction) AS best FROM bl GROUP BY team ORDER BY best DESC, team LIMIT 12)")
def best_per_team(spark, sf):
    return blended_predictions(spark, sf).groupBy("team").agg(F.max("prediction").alias("best")).orderBy(F.col("best").desc(), "team").limit(12)


@query("E2", "rk:int strong:flag name team prediction:num", _BLEND + """,
r AS (SELECT row_number() OVER (ORDER BY prediction DESC, name, team) AS rk, row_number() OVER (ORDER BY prediction DESC, name, team) <= 5 AS strong, * FROM bl QUALIFY rk <= 25)""")
def rank_rows(spark, sf):
    return report.rank_rows(blended_predictions(spark, sf), [F.col("prediction").desc(), F.col("name"), F.col("team")])


@query("F5", "GW:int kickoff:time", "SELECT GW, kickoff FROM v_fixtures ORDER BY kickoff DESC, seq DESC LIMIT 5")
def last_kickoffs(spark, sf):
    return fixtures(spark, sf).orderBy(F.col("kickoff").desc(), F.col("seq").desc()).limit(5)


@query("F4", "seq:int", """SELECT seq FROM v_panel ORDER BY ('0x' || substr(md5(concat(seq::VARCHAR, '|42')), 1, 8))::UBIGINT, seq LIMIT 100""")
def sample_rows(spark, sf):
    return panel(spark, sf).select("seq").orderBy(S.hash_unit(F.col("seq"), seed=42), "seq").limit(100)


@query("B18 B19", "o_orderkey:int home:num draw:num away:num", """
  SELECT o_orderkey, CASE WHEN t = 0 THEN 0 ELSE h / t END AS home, CASE WHEN t = 0 THEN 0 ELSE d / t END AS draw, CASE WHEN t = 0 THEN 0 ELSE a / t END AS away
  FROM (SELECT *, h + d + a AS t FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 / (1.2 + o_orderkey % 7) END AS h,
    CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 / 3.4 END AS d, CASE WHEN o_orderkey % 11 = 0 OR o_custkey % 5 = 0 THEN 0 ELSE 1 / (1.5 + o_custkey % 5) END AS a FROM orders))""")
def devig(spark, sf):
    odds = table(spark, sf, "orders").select("o_orderkey", *[F.when(F.col("o_orderkey") % 11 == 0, 0.0).otherwise(x).alias(n) for n, x in (
        ("h", F.lit(1.2) + F.col("o_orderkey") % 7), ("d", F.lit(3.4)), ("a", F.when(F.col("o_custkey") % 5 != 0, F.lit(1.5) + F.col("o_custkey") % 5)))])
    p = S.without_overround([S.implied_probability(F.col(c)) for c in ("h", "d", "a")])
    return odds.select("o_orderkey", *[x.alias(n) for x, n in zip(p, ("home", "draw", "away"))])


@query("C8 B20", "event_id:int GW:int", """WITH f AS (SELECT kickoff, arg_max(GW, seq) AS GW FROM v_fixtures GROUP BY kickoff),
o AS (SELECT event_id, date_trunc('day', ts) + (9 + event_id % 12) * INTERVAL 1 HOUR + CASE WHEN event_id % 3 = 0 THEN INTERVAL 30 SECOND WHEN event_id % 3 = 1 THEN INTERVAL 29 SECOND ELSE INTERVAL 31 SECOND END AS t FROM events),
m AS (SELECT event_id, date_trunc('minute', t) + CASE WHEN event_id % 3 = 2 THEN INTERVAL 1 MINUTE ELSE INTERVAL 0 MINUTE END AS t FROM o),
r AS (SELECT event_id, GW FROM m JOIN f ON f.kickoff = m.t)""")
def odds_tag(spark, sf):
    ev = table(spark, sf, "events")
    late = F.when(F.col("event_id") % 3 == 0, 30).when(F.col("event_id") % 3 == 1, 29).otherwise(31)
    t = F.date_trunc("day", "ts").cast("timestamp") + F.make_dt_interval(hours=(F.lit(9) + F.col("event_id") % 12).cast("int"), secs=late)
    odds = ev.select("event_id", S.round_minute(t).alias("kickoff"))
    fx = fixtures(spark, sf).withColumn("kickoff", F.col("kickoff").cast("timestamp"))
    return merge.tag_odds(odds, fx)[0]


@query("C11 B14", "element:int name ExpPts:num price:num", _LEFT_SQL + """, picks AS (SELECT DISTINCT element, name, team FROM v_panel WHERE element % 10 = 1),
r AS (SELECT p.element, p.name, "ExpPts", price FROM picks p LEFT JOIN sel ON sel.name = p.name AND sel.team = p.team)""")
def squad_enrich(spark, sf):
    picks = panel(spark, sf).where("element % 10 = 1").select("element", "name", "team").distinct()
    return picks.join(selection_pool(spark, sf), ["name", "team"], "left")


