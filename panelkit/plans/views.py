"""The panel, team and fixture views that queries build from the given tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PANEL = """
SELECT event_id AS seq, user_id AS element, concat('P', CAST(user_id - CASE WHEN user_id % 50 = 49 THEN 1 ELSE 0 END AS {s})) AS name, gw AS GW,
  CAST((user_id + CASE WHEN user_id % 7 = 0 AND gw > 15 THEN 1 ELSE 0 END) % 25 AS INT) AS team_id,
  concat('NATION_', CAST((user_id + CASE WHEN user_id % 7 = 0 AND gw > 15 THEN 1 ELSE 0 END) % 25 AS {s})) AS team,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CASE (user_id + CASE WHEN user_id % 11 = 0 AND gw > 20 THEN 1 ELSE 0 END) % 4
    WHEN 0 THEN 'GK' WHEN 1 THEN 'DEF' WHEN 2 THEN 'MID' ELSE 'FWD' END END AS position,
  CAST(1 + (user_id % 4) AS INT) AS element_type,
  CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(event_id % 25 AS INT) END AS opponent_team,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS home_text,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id % 2 = 0 END AS was_home,
  CASE WHEN value > 90 THEN 90.0 ELSE value END AS minutes, k AS threat, k * 0.5 + event_id % 7 AS creativity, value / 10 AS influence,
  CAST(event_id % 40 AS DOUBLE) / 8 AS expected_goals_conceded,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS goals_scored, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS assists,
  CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS clean_sheets,
  CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_type = 'error' THEN 1 ELSE 0 END AS yellow_cards, CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END AS red_cards,
  CAST(event_id % 4 AS INT) AS bonus, CAST(event_id % 50 AS INT) AS bps, CAST(40 + user_id % 100 AS INT) AS value_tenths, ts
FROM (SELECT event_id, ts, user_id, event_type, value, {k} AS k, {gw} AS gw FROM events) e
"""
_TEAMS = """
SELECT id, name, 1000 + sh % 300 AS attack_home, 1000 + ch % 300 AS attack_away, 1000 + (sh + ch) % 300 AS defence_home,
  1000 + (sh * 2) % 300 AS defence_away, 1000 + (sh + 50) % 300 AS overall_home, 1000 + (ch + 70) % 300 AS overall_away
FROM (SELECT n_nationkey AS id, n_name AS name, CAST(coalesce(s.m, 0) AS INT) AS sh, CAST(coalesce(c.m, 0) AS INT) AS ch
  FROM nation LEFT JOIN (SELECT s_nationkey, floor(abs(avg(s_acctbal))) AS m FROM supplier GROUP BY s_nationkey) s ON s_nationkey = n_nationkey
  LEFT JOIN (SELECT c_nationkey, floor(abs(avg(c_acctbal))) AS m FROM customer GROUP BY c_nationkey) c ON c_nationkey = n_nationkey
  WHERE n_nationkey < 24) t
"""
_FIXTURES = """
SELECT gw AS GW, gw * 100 + k AS seq, CAST((k + gw) % 25 AS INT) AS team_h, CAST((24 - k + gw) % 25 AS INT) AS team_a, day + (20 - k) * INTERVAL 1 HOUR AS kickoff
FROM (SELECT DISTINCT {gw} AS gw, date_trunc('day', ts) AS day FROM events) g JOIN (SELECT n_nationkey AS k FROM nation WHERE n_nationkey < 12) n ON true
UNION ALL
SELECT gw, gw * 100 + 50, 0, 1, day + 22 * INTERVAL 1 HOUR FROM (SELECT DISTINCT {gw} AS gw, date_trunc('day', ts) AS day FROM events) g WHERE gw % 5 = 0
"""
_SPARK = {"s": "STRING", "k": "CAST(get_json_object(props, '$.k') AS DOUBLE)", "gw": "datediff(to_date(ts), DATE'2024-01-01') + 1"}
_DUCK = {"s": "VARCHAR", "k": "CAST(json_extract_string(props, '$.k') AS DOUBLE)", "gw": "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INT)"}

#: Further columns of the panel, the same text in both.
_WIDE = """CASE WHEN seq % 43 = 0 THEN NULL ELSE threat / 20 + bonus END AS xP, CAST((seq * 37) % 1009 AS INT) AS transfers_in,
  threat * minutes / 9000 + goals_scored * 0.3 AS expected_goals, (influence + creativity + threat) / 10 AS ict_index,
  CASE WHEN minutes >= 60 THEN 1 ELSE 0 END AS starts, CAST(seq % 6 AS INT) AS saves, creativity / 400 + assists * 0.2 AS expected_assists"""
#: A step that oracles of wide queries put first.
WIDE_CTE = f"v_wide AS (SELECT *, {_WIDE} FROM v_panel)"

#: CTEs that open every oracle.
CTES = f"WITH v_panel AS ({_PANEL.format(**_DUCK)}), v_teams AS ({_TEAMS}), v_fixtures AS ({_FIXTURES.format(**_DUCK)})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_PANEL.format(**_SPARK).replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


def wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with the further columns that the models' feature lists ask for."""
    return spark.sql(f"SELECT *, {_WIDE} FROM {{p}}", p=panel(spark, sf_dir))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return spark.sql(_TEAMS.replace("FROM nation", "FROM {nation}").replace("FROM supplier", "FROM {supplier}").replace("FROM customer", "FROM {customer}"),
                     nation=t("nation"), supplier=t("supplier"), customer=t("customer"))


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve matches in each period, one team idle, and a second match of two teams in every fifth period."""
    days = table(spark, sf_dir, "events").select(
        F.expr(_SPARK["gw"]).alias("gw"), F.date_trunc("day", "ts").alias("day")).distinct()
    slots = table(spark, sf_dir, "nation").where("n_nationkey < 12").select(F.col("n_nationkey").alias("k"))
    main = days.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11)))).join(slots, "k").selectExpr(
        "gw AS GW", "gw * 100 + k AS seq", "CAST((k + gw) % 25 AS INT) AS team_h", "CAST((24 - k + gw) % 25 AS INT) AS team_a", "day + (20 - k) * INTERVAL 1 HOUR AS kickoff")
    return main.union(days.where("gw % 5 = 0").selectExpr("gw", "gw * 100 + 50", "0", "1", "day + 22 * INTERVAL 1 HOUR"))


