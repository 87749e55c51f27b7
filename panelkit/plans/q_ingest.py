"""Queries: ingest of texts that are built from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.shared import shared_dir
from panelkit.operators import clean
from panelkit.plans.catalogue import query
from panelkit.plans.views import fixtures, panel, table
from panelkit.sources import ingest
from panelkit.streaming.incremental import append_once, ingest_batch, stream_panel

_NARROW = ["name", "seq", "GW", "minutes", *[f"c{i}" for i in range(38)]]           # 42 cells
_WIDE = ["name", "seq", "extra", "GW", "minutes", *[f"c{i}" for i in range(44)]]     # 49 cells


def panel_lines(spark, sf):
    """CSV lines of 42, 49, 1 and 50 cells, with quoted commas in names."""
    name = F.concat(F.lit('"'), F.col("name"), F.lit(', jr"'))
    seq, gw, minutes = (F.col(c).cast("string") for c in ("seq", "GW", "minutes"))
    pad = lambda n: F.lit("," * n)
    wide = F.concat_ws(",", name, seq, F.lit("x"), gw, minutes)
    line = F.when(F.col("seq") % 10 == 0, F.concat(wide, pad(44))).when(F.col("seq") % 10 == 1, F.lit("broken")).when(
        F.col("seq") % 10 == 2, F.concat(wide, pad(45))).otherwise(F.concat(F.concat_ws(",", name, seq, gw, minutes), pad(38)))
    return panel(spark, sf).select("seq", line.alias("line"))


@query("A3 B1", "name seq:int GW:int minutes:num extra", """
  SELECT name || ', jr' AS name, seq, GW, minutes, CASE WHEN seq % 10 = 0 THEN 'x' END AS extra FROM v_panel WHERE seq % 10 NOT IN (1, 2)""")
def ragged_repair(spark, sf):
    rows = ingest.parse_lines(panel_lines(spark, sf), "line", {42: _NARROW, 49: _WIDE})
    return clean.coerce_numeric(rows.select("name", "seq", "GW", "minutes", "extra"), ["seq", "GW", "minutes"])


@query("A4", "arity:int n:int accepted:flag", """
  SELECT a AS arity, count(*) AS n, a IN (42, 49) AS accepted FROM (SELECT CASE seq % 10 WHEN 0 THEN 49 WHEN 1 THEN 1 WHEN 2 THEN 50 ELSE 42 END AS a FROM v_panel) GROUP BY a""")
def ragged_report(spark, sf):
    return ingest.ragged_report(panel_lines(spark, sf), "line", [42, 49])


@query("A1", "name seq:int GW:int", """
  SELECT CASE WHEN seq % 10 = 1 THEN 'broken' ELSE name || ', jr' END AS name, CASE WHEN seq % 10 <> 1 THEN seq END AS seq, CASE WHEN seq % 10 <> 1 THEN GW END AS GW
  FROM v_panel WHERE seq % 10 NOT IN (0, 2)""")
def scan_lines(spark, sf):
    rows = ingest.parse_lines(panel_lines(spark, sf), "line", {42: _NARROW}, pad=True)
    return clean.coerce_numeric(rows.select("name", "seq", "GW"), ["seq", "GW"])


def fixture_lines(spark, sf):
    iso = F.when(F.col("seq") % 7 == 0, F.lit("")).otherwise(F.date_format("kickoff", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return fixtures(spark, sf).select(F.concat_ws(",", F.col("GW").cast("string"), iso, F.col("team_h").cast("string"), F.col("team_a").cast("string")).alias("line"))


@query("A2 A7", "GW:int kickoff:time team_h:int team_a:int", "SELECT GW, kickoff, team_h, team_a FROM v_fixtures WHERE seq % 7 <> 0")
def clean_fixtures(spark, sf):
    return ingest.clean_fixtures(ingest.read_fixtures(fixture_lines(spark, sf), "line"))


@query("A5", "id:int stats_k:num stats_kind", """
  SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS stats_k, event_type AS stats_kind FROM events""")
def json_flatten(spark, sf):
    item = F.struct(F.col("event_id").alias("id"), F.struct(F.get_json_object("props", "$.k").cast("double").alias("k"), F.col("event_type").alias("kind")).alias("stats"))
    docs = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.to_json(F.collect_list(item)).alias("json"))
    return ingest.normalise_json(docs, "json", "struct<id:bigint,stats:struct<k:double,kind:string>>", sep="_")


@query("A6", "home_team away_team bookmaker odds_home:num odds_draw:num odds_away:num", """
  SELECT 'T' || (o_custkey % 20) AS home_team, 'U' || (o_custkey % 19) AS away_team, 'book' || (o_orderkey % 3) AS bookmaker, 1.5 + o_orderkey % 4 AS odds_home,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 3.25 END AS odds_draw, 2.5 + o_custkey % 3 AS odds_away FROM orders WHERE o_orderkey % 6 <> 0""")
def odds_extract(spark, sf):
    o = table(spark, sf, "orders")
    home, away = F.concat(F.lit("T"), (F.col("o_custkey") % 20).cast("string")), F.concat(F.lit("U"), (F.col("o_custkey") % 19).cast("string"))
    price = lambda n, p: F.struct(n.alias("name"), p.cast("double").alias("price"))
    outcomes = F.array_compact(F.array(price(home, F.lit(1.5) + F.col("o_orderkey") % 4), price(away, F.lit(2.5) + F.col("o_custkey") % 3),
                                       F.when(F.col("o_orderkey") % 5 != 0, price(F.lit("Draw"), F.lit(3.25)))))
    book = lambda t: F.struct(t.alias("title"), F.array(F.struct(outcomes.alias("outcomes"))).alias("markets"))
    books = F.when(F.col("o_orderkey") % 6 == 0, F.array().cast("array<struct<title:string,markets:array<struct<outcomes:array<struct<name:string,price:double>>>>>>")).otherwise(
        F.array(book(F.concat(F.lit("book"), (F.col("o_orderkey") % 3).cast("string"))), book(F.lit("second"))))
    docs = o.select(F.to_json(F.array(F.struct(home.alias("home_team"), away.alias("away_team"), F.lit("2024-01-01T12:00:00Z").alias("commence_time"), books.alias("bookmakers")))).alias("json"))
    return ingest.extract_odds(docs, "json")


@query("A8 C12 B7 B25", "seq:int element:int name team position was_home:flag xP:num", """
  SELECT seq, element, 'W' || element AS name, n_name AS team, CASE element_type WHEN 1 THEN 'GK' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' ELSE 'FWD' END AS position, NULL AS was_home, NULL AS "xP"
  FROM v_panel JOIN nation ON n_nationkey = element % 25 WHERE element % 9 <> 0""")
def conform(spark, sf):
    p = panel(spark, sf)
    players = p.where("element % 9 <> 0").select(F.col("element").alias("id"), F.concat(F.lit("W"), F.col("element").cast("string")).alias("web_name"),
                                                 (F.col("element") % 25).alias("team_id"), "element_type").distinct()
    clubs = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return ingest.conform(p.select("seq", "element", "minutes"), players, clubs, {"minutes": "mins"}, {"was_home": "boolean", "xP": "double"}, ["name", "position", "team"])


@query("A11", "seq:int GW:int", "SELECT seq, GW FROM v_panel WHERE GW = (SELECT max(GW) FROM v_panel)")
def latest_snapshot(spark, sf):
    return ingest.latest_snapshot(panel(spark, sf))


@query("A11", "seq:int GW:int minutes:num period:int", "SELECT seq, GW, minutes, GW AS period FROM v_panel WHERE GW = 10")
def latest_named(spark, sf):
    """Snapshots of periods 8 to 10 lie in the second folder; the first has files without a period in their name."""
    root = f"{shared_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    rows = panel(spark, sf).select("seq", "GW", "minutes")
    rows.where("GW = 12").write.parquet(f"{root}/first/latest.parquet")
    for gw in (9, 10, 8):
        rows.where(F.col("GW") == gw).write.parquet(f"{root}/second/GW{gw}_Predicted.parquet")
    return ingest.latest_named(spark, [f"{root}/none", f"{root}/first", f"{root}/second"])


@query("A12", "name team GW:int minutes:num threat:num", "SELECT name, team, GW, minutes, threat FROM v_panel")
def sink_predictions(spark, sf):
    """Written twice, read back."""
    path = f"{shared_dir(spark)}/predictions-{uuid.uuid4().hex}"
    rows = panel(spark, sf)
    for part in (rows.where("minutes > 30"), rows):
        ingest.write_predictions(part, path, ["name", "team", "not_there", "GW", "minutes", "threat"], ["-minutes", "name", "seq"])
    return spark.read.option("header", True).csv(path)


@query("A13", "element:int name", "SELECT DISTINCT element, name FROM v_panel")
def sink_if_absent(spark, sf):
    """The second writing, of other rows, leaves the first."""
    path = f"{shared_dir(spark)}/elements-{uuid.uuid4().hex}"
    rows = panel(spark, sf).select("element", "name").distinct()
    for part in (rows, rows.where("element % 2 = 0").withColumn("name", F.lit("other"))):
        ingest.write_if_absent(part, path)
    return spark.read.parquet(path)


@query("A14", "GW:int seq:int minutes:num", "SELECT GW, seq, minutes + CASE WHEN GW BETWEEN 8 AND 12 THEN 1 ELSE 0 END AS minutes FROM v_panel WHERE GW <= 12")
def sink_snapshots(spark, sf):
    """Periods 1 to 10, then 8 to 12 corrected, twice: the corrected periods replace, nothing is doubled."""
    path = f"{shared_dir(spark)}/periods-{uuid.uuid4().hex}"
    rows = panel(spark, sf).select("GW", "seq", "minutes")
    ingest.write_period_snapshots(rows.where("GW <= 10"), path)
    for _ in range(2):
        ingest.write_period_snapshots(rows.where("GW BETWEEN 8 AND 12").withColumn("minutes", F.col("minutes") + 1), path)
    return spark.read.parquet(path)


_PROFILED = {"seq": "n", "name": "t", "GW": "n", "team": "t", "position": "t", "opponent_team": "n", "was_home": "f", "minutes": "n", "threat": "n", "yellow_cards": "n", "ts": "s"}
_EDGE = {"n": ("min({c})::DOUBLE", "max({c})::DOUBLE", "NULL", "NULL"), "f": ("min({c}::INT)::DOUBLE", "max({c}::INT)::DOUBLE", "NULL", "NULL"),
         "t": ("NULL::DOUBLE", "NULL::DOUBLE", "min({c})", "max({c})"), "s": ("epoch_us(min({c})) / 1e6", "epoch_us(max({c})) / 1e6", "NULL", "NULL")}


@query("D17", "column n:int n_null:int lo:num hi:num first last", "WITH r AS (" + " UNION ALL ".join(
    "SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS n_null, {0} AS lo, {1} AS hi, {2} AS \"first\", {3} AS \"last\" FROM v_panel".format(
        *[x.format(c=c) for x in _EDGE[k]], c=c) for c, k in _PROFILED.items()) + ")")
def profile(spark, sf):
    return ingest.profile(panel(spark, sf).select(*_PROFILED))


@query("A15", "seq:int x:num", """
  SELECT seq, CASE WHEN v = 0 THEN 0 ELSE round_even(v / pow(10.0, floor(log10(abs(v))) - 3), 0) * pow(10.0, floor(log10(abs(v))) - 3) END AS x
  FROM (SELECT seq, threat * 1234.5678 + influence AS v FROM v_panel)""")
def four_digits(spark, sf):
    return panel(spark, sf).select("seq", S.significant(F.col("threat") * 1234.5678 + F.col("influence"), 4).alias("x"))


@query("S1", "element:int fixture:int seq:int", """WITH a AS (SELECT *, GW * 100 + seq % 7 AS fixture FROM v_panel),
b AS (SELECT DISTINCT element, fixture FROM a WHERE GW <= 10),
r AS (SELECT element, fixture, min(seq) AS seq FROM a WHERE GW BETWEEN 8 AND 20 AND (element, fixture) NOT IN (SELECT element, fixture FROM b) GROUP BY element, fixture)""")
def stream_batch(spark, sf):
    rows = panel(spark, sf).withColumn("fixture", F.col("GW") * 100 + F.col("seq") % 7).select("element", "fixture", "seq", "GW")
    return ingest_batch(rows.where("GW <= 10"), rows.where("GW BETWEEN 8 AND 20"))



@query("S1", "element:int fixture:int seq:int GW:int", """WITH a AS (SELECT *, GW * 100 + seq % 7 AS fixture FROM v_panel WHERE GW <= 20),
r AS (SELECT element, fixture, min(seq) AS seq, GW FROM a GROUP BY element, fixture, GW)""")
def stream_ingest(spark, sf):
    """The stream over files that land in three deliveries, stopped after each and started again from its checkpoint.

    The target starts with periods 1 to 10. The first delivery has periods 8 to 13; the second 14 to 16 and the first's
    files once more; the third 17 to 20 and a copy of the second's rows in files of other names.
    """
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = panel(spark, sf).where("GW <= 20").withColumn("fixture", F.col("GW") * 100 + F.col("seq") % 7).select(
        "element", "fixture", "seq", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("kickoff"), "GW")
    schema, target = "element bigint, fixture bigint, seq bigint, kickoff timestamp, GW int", f"{root}/target"
    typed = rows.select(*[F.col(c).cast(k).alias(c) for c, k in (x.split() for x in schema.split(", "))])
    append_once(typed.where("GW <= 10"), 0, target, f"{root}/loaded", order="seq")
    for low, high, again in ((8, 13, None), (14, 16, (8, 13)), (17, 20, (14, 16))):
        for a, b in filter(None, ((low, high), again)):
            rows.where(F.col("GW").between(a, b)).write.mode("append").option("header", True).csv(f"{root}/landed")
        stream_panel(spark, f"{root}/landed", schema, target, f"{root}/checkpoint", order="seq", row_keys=("element", "fixture", "seq")).awaitTermination()
    return spark.read.schema(schema).parquet(target)
