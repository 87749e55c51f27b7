"""Queries: quotas, elevens, audits, scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import report, select
from panelkit.plans.catalogue import query
from panelkit.plans.q_reports import _LEFT_SQL, selection_pool

_ORDER = '"ExpPts" DESC, name, team'
_QUOTA = "CASE position WHEN 'GK' THEN 2 WHEN 'DEF' THEN 5 WHEN 'MID' THEN 5 WHEN 'FWD' THEN 3 ELSE 0 END"


def _quota_sql(src: str, keys: str = "") -> str:
    k = keys + ", " if keys else ""
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k}position ORDER BY {_ORDER}) AS role_rank FROM
  (SELECT *, row_number() OVER (PARTITION BY {k}team ORDER BY {_ORDER}) AS club_rank FROM {src}) WHERE club_rank <= 3) WHERE role_rank <= {_QUOTA}"""


# squads of teams whose number leaves the same rest, so several squads are chosen at once
_POOL = _LEFT_SQL + ", pool AS (SELECT *, CAST(substr(team, 8) AS INT) % 3 AS squad FROM sel)"
_PICK = _POOL + f", pick AS ({_quota_sql('pool', 'squad')})"
_XI = _PICK + f""", pre AS (SELECT *, row_number() OVER (PARTITION BY squad, position ORDER BY {_ORDER}) AS k,
  sum("ExpPts") OVER (PARTITION BY squad, position ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) AS s FROM pick),
f AS (SELECT * FROM (VALUES {", ".join(f"({i}, {d}, {m}, {f})" for i, (d, m, f) in enumerate(select.FORMATIONS))}) t(o, d, m, f)),
val AS (SELECT g.squad, o, d, m, f, round(g.s + a.s + b.s + c.s, 9) AS v FROM f JOIN pre g ON g.position = 'GK' AND g.k = 1 JOIN pre a ON a.squad = g.squad AND a.position = 'DEF' AND a.k = d
  JOIN pre b ON b.squad = g.squad AND b.position = 'MID' AND b.k = m JOIN pre c ON c.squad = g.squad AND c.position = 'FWD' AND c.k = f),
best AS (SELECT squad, arg_max((d, m, f), (v, -o)) AS x FROM val GROUP BY squad),
xi AS (SELECT pre.*, coalesce((k <= CASE position WHEN 'GK' THEN 1 WHEN 'DEF' THEN x[1] WHEN 'MID' THEN x[2] ELSE x[3] END)::INT, 0) AS xi_ FROM pre LEFT JOIN best USING (squad))"""


def pools(spark, sf):
    return selection_pool(spark, sf).withColumn("squad", F.expr("CAST(substr(team, 8) AS INT) % 3"))


def picked(spark, sf):
    return select.quota_top_k(pools(spark, sf), club_cap=3, keys=("squad",))


def squads(spark, sf):
    return select.best_xi(picked(spark, sf))


@query("J1", "squad:int name team position role_rank:int ExpPts:num", _PICK + ", r AS (SELECT * FROM pick)")
def quota_topk(spark, sf):
    return picked(spark, sf)


@query("J1", "squad:int position quota:int missing:int", _POOL + f""", pick AS ({_quota_sql("(SELECT * FROM pool WHERE name LIKE '%1')", 'squad')}),
q AS (SELECT squad, position, quota FROM (SELECT DISTINCT squad FROM pick), (VALUES ('GK', 2), ('DEF', 5), ('MID', 5), ('FWD', 3)) t(position, quota)),
r AS (SELECT squad, position, quota, quota - (SELECT count(*) FROM pick WHERE pick.squad = q.squad AND pick.position = q.position) AS missing FROM q WHERE missing > 0)""")
def quota_shortfall(spark, sf):
    few = select.quota_top_k(pools(spark, sf).where("name LIKE '%1'"), club_cap=3, keys=("squad",))
    return select.shortfall(few, keys=("squad",))


@query("J3", "squad:int name team position XI:int", _XI + ', r AS (SELECT *, xi_ AS "XI" FROM xi)')
def best_xi(spark, sf):
    return squads(spark, sf)


@query("J4", "squad:int rule found:num", _XI + """, a AS (SELECT squad, count(*) AS size, sum(xi_) AS xi_size, round(sum(price), 6) AS budget,
  count(*) FILTER (position = 'GK') AS q1, count(*) FILTER (position = 'DEF') AS q2, count(*) FILTER (position = 'MID') AS q3, count(*) FILTER (position = 'FWD') AS q4,
  count(*) FILTER (position = 'GK' AND xi_ = 1) AS x1, count(*) FILTER (position = 'DEF' AND xi_ = 1) AS x2, count(*) FILTER (position = 'MID' AND xi_ = 1) AS x3,
  count(*) FILTER (position = 'FWD' AND xi_ = 1) AS x4 FROM xi GROUP BY squad),
r AS (SELECT squad, 'size' AS rule, size AS found FROM a WHERE size <> 15 UNION ALL SELECT squad, 'xi_size', xi_size FROM a WHERE xi_size <> 11
  UNION ALL SELECT squad, 'budget', budget FROM a WHERE budget > 80 UNION ALL SELECT squad, 'quota_GK', q1 FROM a WHERE q1 <> 2
  UNION ALL SELECT squad, 'quota_DEF', q2 FROM a WHERE q2 <> 4 UNION ALL SELECT squad, 'quota_MID', q3 FROM a WHERE q3 <> 5 UNION ALL SELECT squad, 'quota_FWD', q4 FROM a WHERE q4 <> 3
  UNION ALL SELECT squad, 'xi_GK', x1 FROM a WHERE x1 <> 1 UNION ALL SELECT squad, 'xi_DEF', x2 FROM a WHERE x2 < 3
  UNION ALL SELECT squad, 'xi_MID', x3 FROM a WHERE x3 < 2 UNION ALL SELECT squad, 'xi_FWD', x4 FROM a WHERE x4 < 1
  UNION ALL SELECT squad, 'club_cap', n FROM (SELECT squad, max(n) AS n FROM (SELECT squad, team, count(*) AS n FROM xi GROUP BY ALL) GROUP BY squad) WHERE n > 1)""")
def squad_audit(spark, sf):
    # stricter rules than the game's, so that some break
    return select.audit(squads(spark, sf), budget=80.0, quota={"GK": 2, "DEF": 4, "MID": 5, "FWD": 3}, club_cap=1).where(
        "rule NOT IN ('size') OR found <> 15")


@query("J7", "squad:int name team position XI:int ExpPts:num", _XI + ', r AS (SELECT *, xi_ AS "XI" FROM xi WHERE xi_ = 1)')
def squad_output(spark, sf):
    return select.squad_output(squads(spark, sf), only_xi=True)


@query("J8 D13", "price:num points:num points_per_price:num", _XI + ', r AS (SELECT sum(price) AS price, sum("ExpPts") AS points, sum("ExpPts") / sum(price) AS points_per_price FROM xi WHERE xi_ = 1)')
def kpi(spark, sf):
    return report.kpi(squads(spark, sf).where("XI = 1"), "price", "ExpPts")


@query("J8 D14", "squad:int formation", _XI + """, r AS (SELECT squad, concat(count(*) FILTER (position = 'DEF'), '-', count(*) FILTER (position = 'MID'), '-', count(*) FILTER (position = 'FWD')) AS formation
  FROM xi WHERE xi_ = 1 GROUP BY squad)""")
def formation(spark, sf):
    return report.formation(squads(spark, sf).where("XI = 1"), ("squad",))


@query("J9", "cause n:int", _LEFT_SQL + """, r AS (SELECT CASE WHEN price < 4.5 THEN 'low' ELSE 'high' END AS cause, count(*) AS n FROM sel WHERE price < 4.5 OR price > 12 GROUP BY 1)""")
def price_check(spark, sf):
    return select.price_check(selection_pool(spark, sf), 4.5, 12.0)


def _unit(seed: int) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', name, team, '{seed}')), 1, 8))::UBIGINT / 4294967296.0)"


_NOISE = _LEFT_SQL + f""", noisy AS (SELECT name, team, position, price, level, round("ExpPts" + level * 0.01 * sqrt(-2 * ln(greatest({_unit(42)}, 1e-12))) * cos(6.283185307179586 * {_unit(43)}), 6) AS "ExpPts"
  FROM sel, (VALUES (0), (1), (4), (5)) l(level))"""
_LEVELS = [0, 1, 4, 5]


@query("J5", "name team level:int ExpPts:num", _NOISE + ", r AS (SELECT * FROM noisy)")
def noise_levels(spark, sf):
    return select.noise_levels(selection_pool(spark, sf), _LEVELS)


@query("J6", "name team share:num in_base:int", _NOISE + f""", pick AS ({_quota_sql('noisy', 'level')}),
r AS (SELECT name, team, count(*) / 4.0 AS share, max((level = 0)::INT) AS in_base FROM pick GROUP BY name, team)""")
def noise_stability(spark, sf):
    noisy = select.noise_levels(selection_pool(spark, sf), _LEVELS)
    return select.stability(select.quota_top_k(noisy, club_cap=3, keys=("level",)), len(_LEVELS))


@query("J2", "level:int status value:num bound:num gap:num cost:num")
def squad_search(spark, sf):
    return select.squad_search(select.noise_levels(selection_pool(spark, sf), _LEVELS), ("level",))
