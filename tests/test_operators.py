"""Hand-built rows for the semantics that the queries' data may not reach."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import clean, features, merge, models, report, select
from panelkit.sources import ingest
from panelkit.streaming.incremental import stream_panel


def one(df):
    return df.first()[0]


def test_rounding_is_half_even_and_significant(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.675,)], "x double")
    assert [r[0] for r in df.select(S.half_even(F.col("x"), 2)).collect()] == [0.12, 0.38, 2.68]
    df = spark.createDataFrame([(123456.0,), (0.0,), (-0.00123456,)], "x double")
    assert [r[0] for r in df.select(F.round(S.significant(F.col("x")), 9)).collect()] == [123500.0, 0.0, -0.001235]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(S.clip(F.col("x"), 0.0, 1.0)).collect()] == [None, 1.0, 0.0]


def test_odds(spark):
    df = spark.createDataFrame([(2.0, 4.0, 4.0), (0.0, None, 0.0), (2.0, 2.0, 2.0)], "a double, b double, c double")
    p = S.without_overround([S.implied_probability(F.col(c)) for c in "abc"])
    rows = [tuple(r) for r in df.select(*p).collect()]
    assert rows[0] == (0.5, 0.25, 0.25) and rows[1] == (0.0, 0.0, 0.0)
    assert math.isclose(sum(rows[2]), 1.0)


def test_half_minutes_go_to_the_even_minute(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:30",), ("2024-01-01 10:01:30",), ("2024-01-01 10:01:29",)], "t string")
    out = [r[0] for r in df.select(F.date_format(S.round_minute(F.col("t").cast("timestamp")), "HH:mm")).collect()]
    assert out == ["10:00", "10:02", "10:01"]


TEAMS = [(1, "A", 1200, 1210, 1220, 1230, 1240, 1250), (2, "B", 1100, 1110, 1120, 1130, 1140, 1150)]
TEAM_SCHEMA = "id int, name string, attack_home int, attack_away int, defence_home int, defence_away int, overall_home int, overall_away int"


def test_fixture_attach_takes_the_first_in_file_order_and_marks_blanks(spark):
    teams = spark.createDataFrame(TEAMS, TEAM_SCHEMA)
    fx = spark.createDataFrame([(5, 1, 1, 2, "2024-01-02 20:00:00"), (5, 2, 2, 1, "2024-01-02 12:00:00")], "GW int, seq int, team_h int, team_a int, kickoff string")
    rows = spark.createDataFrame([(5, 1), (5, 3), (6, 1)], "GW int, team_id int")
    got = {(r["GW"], r["team_id"]): (r["opponent"], r["at_home"]) for r in features.attach_fixture(rows, fx, teams).collect()}
    assert got == {(5, 1): ("B", True), (5, 3): ("Unknown", False), (6, 1): ("Unknown", False)}
    by_time = features.attach_fixture(rows.where("GW = 5 AND team_id = 1"), fx, teams, order="kickoff").first()
    assert by_time["at_home"] is False


def test_strength_defaults_and_venues(spark):
    teams = spark.createDataFrame(TEAMS, TEAM_SCHEMA)
    rows = spark.createDataFrame([("A", 2, None), ("A", 2, False), ("Z", None, True)], "team string, opponent_team int, was_home boolean")
    a = features.enrich_strength(rows, teams).select("team_attack", "opp_defence", "team_overall", "opp_overall").collect()
    assert [tuple(r) for r in a] == [(1200, 1130, 1240, 1150), (1210, 1120, 1250, 1140), (1100, 1100, 1100, 1100)]
    d = features.enrich_strength(rows, teams, "defence").select("opp_attack", "opp_overall").first()
    assert tuple(d) == (1110, 1140)  # the opponent's overall strength follows the team's venue here


def test_rolling_mean_counts_filtered_rows_and_skips_missing_keys(spark):
    df = spark.createDataFrame([("p", 1, 1, 10.0), ("p", 2, 2, None), ("p", 3, 3, 40.0), (None, 1, 4, 7.0)], "name string, GW int, seq int, m double")
    got = {r["seq"]: r["roll3_m"] for r in features.rolling_mean(df, ["m"]).collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 25.0, 4: None}
    shifted = {r["seq"]: r["roll3_m"] for r in features.rolling_mean(df, ["m"], shift=1).collect()}
    assert shifted[1] is None and shifted[3] == 10.0


def test_merge_metrics_matches_missing_keys_and_fans_out(spark):
    a = spark.createDataFrame([("x", None, 1.0), ("y", "T", 2.0), ("y", "T", 3.0)], "name string, team string, g double")
    b = spark.createDataFrame([("x", None, 5.0), ("z", "T", 6.0)], "name string, team string, h double")
    got = sorted(map(str, (tuple(r) for r in merge.merge_metrics([a, b], ["name", "team"], {"g": 0.0, "h": 0.0}).collect())))
    assert got == sorted(map(str, [("x", None, 1.0, 5.0), ("y", "T", 2.0, 0.0), ("y", "T", 3.0, 0.0), ("z", "T", 0.0, 6.0)]))


def test_unmatched_odds_are_counted(spark):
    fx = spark.createDataFrame([(1, 1, "t1"), (2, 2, "t1")], "GW int, seq int, kickoff string")
    odds = spark.createDataFrame([("t1",), ("t2",)], "kickoff string")
    tagged, missing = merge.tag_odds(odds, fx)
    assert tagged.first()["GW"] == 2 and one(missing) == 1


def test_quantile_is_exact(spark):
    df = spark.range(1, 11).select(F.col("id").cast("double").alias("x"))
    assert math.isclose(one(report.exact_quantile(df, "x", 0.99, buckets=3)), 9.91)
    assert one(report.exact_quantile(df.where("x < 0"), "x", 0.5)) is None
    same = spark.range(50).select(F.lit(4.0).alias("x"))
    assert one(report.exact_quantile(same, "x", 0.3)) == 4.0


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (9.0,), (None,)], "x double")
    assert [r["n"] for r in report.bin_counts(df, "x", [0.0, 1.0, 2.0], True).orderBy("bin").collect()] == [2, 2]
    assert [r["n"] for r in report.bin_counts(df, "x", [0.0, 1.0, 2.0]).orderBy("bin").collect()] == [1, 2]


def test_zero_deviation_and_slope(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 4.0)], "x double, raw double, adj double")
    assert features.zscore(df, "raw", "z").first()["z"] is None
    assert report.trend_impact(df, "x", "raw", "adj").first()["change_pct"] == float("inf")


def _squad(spark, rows):
    return spark.createDataFrame([(0, f"p{i}", t, r, float(price), float(e)) for i, (t, r, price, e) in enumerate(rows)],
                                 "squad int, name string, team string, position string, price double, ExpPts double")


def test_best_eleven_beats_every_legal_one(spark):
    rows = [("A", "GK", 5, 3.1), ("B", "GK", 4, 2.0)] + [("C", "DEF", 5, 4 - i * 0.7) for i in range(5)] + [
        ("D", "MID", 6, 5 - i * 0.9) for i in range(5)] + [("E", "FWD", 7, 4.5 - i * 1.5) for i in range(3)]
    got = select.best_xi(_squad(spark, rows))
    value = got.where("XI = 1").agg(F.sum("ExpPts")).first()[0]
    legal = [x for x in itertools.combinations(rows, 11) if (n := [sum(r[1] == p for r in x) for p in ("GK", "DEF", "MID", "FWD")])
             and n[0] == 1 and n[1] >= 3 and n[2] >= 2 and n[3] >= 1]
    assert math.isclose(value, max(sum(r[3] for r in x) for x in legal))
    assert select.audit(got, club_cap=5).count() == 0
    assert {r["rule"] for r in select.audit(got, budget=50.0, club_cap=5).collect()} == {"budget"}


def test_shortfall_reports_short_roles(spark):
    few = _squad(spark, [("A", "GK", 5, 1), ("B", "DEF", 5, 1)])
    got = {r["position"]: r["missing"] for r in select.shortfall(select.quota_top_k(few)).collect()}
    assert got == {"GK": 1, "DEF": 4, "MID": 5, "FWD": 3}


def test_pruned_candidates_keep_the_best_squad(spark):
    import random

    rnd = random.Random(3)
    quota = {"GK": 1, "DEF": 1, "MID": 1}
    for _ in range(3):
        rows = [(rnd.choice("AB"), r, rnd.choice([4, 5]), rnd.randint(0, 9)) for r in ("GK", "DEF", "MID") for _ in range(4)]
        pool = _squad(spark, rows)
        best = lambda xs: max((sum(r[3] for r in s) for s in itertools.product(*[[x for x in xs if x[1] == p] for p in quota])
                               if sum(r[2] for r in s) <= 14 and all([r[0] for r in s].count(t) <= 2 for t in "AB")), default=None)
        kept = [(r["team"], r["position"], r["price"], r["ExpPts"]) for r in select.useful_candidates(pool, ("squad",), quota, 2).collect()]
        assert best(kept) == best([(t, r, float(p), float(e)) for t, r, p, e in rows])


def test_search_gives_a_row_for_every_scenario_and_stays_below_the_bound(spark):
    from panelkit.plans.q_reports import selection_pool

    pool = selection_pool(spark, "/root/testdata/sf0.01").withColumn("s", F.lit(1))
    empty = pool.limit(3).withColumn("s", F.lit(2))
    got = {r["s"]: r for r in select.squad_search(pool.union(empty), ("s",)).collect()}
    assert got[2]["status"] == "none" and got[2]["value"] is None
    assert got[1]["status"] == "feasible" and got[1]["value"] <= got[1]["bound"] + 1e-6 and got[1]["cost"] <= 100
    rows = got[1]["squad"]
    assert len(rows) == 15 and sum(r["XI"] for r in rows) == 11


def test_search_finds_a_squad_where_one_is_legal(spark):
    # each club's best three are forwards; goalkeepers of one club only beside two clubs with every role
    def club(t, price):
        return [(t, "FWD", price, 9), (t, "FWD", price, 9), (t, "FWD", price, 9), (t, "GK", price, 1), *[(t, "DEF", price, 2)] * 3, *[(t, "MID", price, 3)] * 3]

    def scenario(s, price, clubs):
        return _squad(spark, [x for t in clubs for x in club(t, price)]).drop("s").withColumn("s", F.lit(s))

    pool = scenario(1, 4.0, "ABCDEF").union(scenario(2, 7.0, "ABCDEF")).union(scenario(3, 4.0, "ABCD"))
    # cheap players without points, which no multiplier up to 0.8 asks for
    dear = [(t, r, 9.0, 90) for t in "ABCDEF" for r in ("GK", "DEF", "DEF", "MID", "MID", "FWD")]
    cheap = [(t, r, 6.0, 0) for t in "ABCDEF" for r in ("GK", "DEF", "DEF", "MID", "MID", "FWD")]
    pool = pool.union(_squad(spark, dear + cheap).drop("s").withColumn("s", F.lit(4)))
    got = {r["s"]: r for r in select.squad_search(pool, ("s",)).collect()}
    assert {s: r["status"] for s, r in got.items()} == {1: "feasible", 2: "none", 3: "none", 4: "feasible"}
    assert got[1]["cost"] == 60 and got[4]["cost"] <= 100
    for s in (1, 4):
        teams = [x["team"] for x in got[s]["squad"]]
        assert len(teams) == 15 and max(map(teams.count, teams)) <= 3 and got[s]["value"] <= got[s]["bound"] + 1e-6


def test_fillable_equals_a_search(spark):
    import random

    rnd, quota = random.Random(8), {"GK": 1, "DEF": 2, "MID": 2}

    def possible(players, cap):
        for pick in itertools.product(*[itertools.combinations([p for p in players if p[1] == r], n) for r, n in quota.items()]):
            teams = [t for part in pick for t, _ in part]
            if all(teams.count(t) <= cap for t in set(teams)):
                return True
        return False

    pools = {i: [(rnd.choice("ABC"), rnd.choice(list(quota))) for _ in range(rnd.randint(3, 9))] for i in range(60)}
    df = spark.createDataFrame([(i, t, r) for i, rows in pools.items() for t, r in rows], "s int, team string, position string")
    for cap in (2, 3):
        got = {r["s"]: r["ok"] for r in select.fillable(df, ("s",), quota, cap).collect()}
        assert got == {i: possible(rows, cap) for i, rows in pools.items()} and len(set(got.values())) == 2


def test_search_over_random_pools(spark):
    import random

    rnd = random.Random(9)
    rows = []
    for s in range(12):
        teams = "ABCDEFGH"[:rnd.randint(4, 8)]
        for i in range(rnd.randint(14, 60)):
            rows.append((s, f"p{i}", rnd.choice(teams), rnd.choices(["GK", "DEF", "MID", "FWD"], [2, 5, 5, 3])[0], float(rnd.choice([4, 5, 6, 8, 10])), float(rnd.randint(0, 40)) / 4))
    pool = spark.createDataFrame(rows, "s int, name string, team string, position string, price double, ExpPts double")
    found = select.squad_search(pool, ("s",)).collect()
    ok = {r["s"]: r["ok"] for r in select.fillable(pool, ("s",)).collect()}
    for r in found:
        assert r["status"] in ("feasible", "none", "not found") and (r["status"] != "feasible" or ok[r["s"]])
        if r["status"] == "feasible":
            squad = [(x["name"], x["team"]) for x in r["squad"]]
            roles = [x["position"] for x in r["squad"]]
            teams = [t for _, t in squad]
            assert len(set(squad)) == 15 and {p: roles.count(p) for p in select.SQUAD_QUOTA} == select.SQUAD_QUOTA
            assert max(map(teams.count, teams)) <= 3 and r["cost"] <= 100 and r["value"] <= r["bound"] + 1e-6
    assert {r["status"] for r in found} >= {"feasible", "none"} and sum(r["status"] == "not found" for r in found) <= 1


def test_ragged_lines(spark):
    lines = spark.createDataFrame([("a,1",), ('"b,c",2',), ("d,x,3",), ("only",), ("1,2,3,4",)], "v string")
    got = {tuple(r) for r in ingest.parse_lines(lines, "v", {2: ["n", "k"], 3: ["n", "e", "k"]}).collect()}
    assert got == {("a", "1", None), ("b,c", "2", None), ("d", "3", "x")}
    report_ = {r["arity"]: (r["n"], r["accepted"]) for r in ingest.ragged_report(lines, "v", [2, 3]).collect()}
    assert report_ == {2: (2, True), 3: (1, True), 1: (1, False), 4: (1, False)}


def test_files_in_and_out(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a,1,x\nb,2\nc,3,y,z\n")
    rows = sorted(map(tuple, ingest.read_panel(spark, str(tmp_path / "p.csv"), "n string, k int, t string").collect()), key=str)
    assert rows == [("a", 1, "x"), ("b", 2, None)]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "GW int, n string")
    ingest.write_predictions(df, str(tmp_path / "out"), ["n", "gone", "GW"], ["n"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["n", "GW"]
    ingest.write_if_absent(df, str(tmp_path / "dim"))
    ingest.write_if_absent(df.limit(1), str(tmp_path / "dim"))
    assert spark.read.parquet(str(tmp_path / "dim")).count() == 2
    ingest.write_period_snapshots(df, str(tmp_path / "snap"))
    assert ingest.latest_snapshot(spark.read.parquet(str(tmp_path / "snap"))).first()["n"] == "b"
    for n in (9, 10):
        (tmp_path / "two").mkdir(exist_ok=True)
        (tmp_path / "two" / f"GW{n}_x.csv").write_text("a")
    assert ingest.latest_files(spark, [str(tmp_path / "none"), str(tmp_path / "two")]).endswith("GW10_x.csv")


def test_stream_equals_batch_and_redelivery_adds_nothing(spark, tmp_path):
    src, target, check = tmp_path / "in", tmp_path / "t", tmp_path / "c"
    src.mkdir()
    head, lines = "element,fixture,GW,kickoff\n", ["1,1,1,2024-01-01 10:00:00\n", "1,1,1,2024-01-01 10:00:00\n", "2,1,1,2024-01-01 10:00:00\n"]
    (src / "a.csv").write_text(head + "".join(lines))
    schema = "element int, fixture int, GW int, kickoff timestamp"
    run = lambda: stream_panel(spark, str(src), schema, str(target), str(check)).awaitTermination()
    run()
    assert spark.read.parquet(str(target)).count() == 2
    (src / "b.csv").write_text(head + "".join(lines) + "3,2,2,2024-01-02 10:00:00\n")
    run()
    assert spark.read.parquet(str(target)).count() == 3


def test_models(spark):
    rows = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), ((F.col("id") * 7) % 11).cast("double").alias("z"))
    rows = rows.withColumn("y", F.col("x") * 2 + F.col("z") * 0.1).withColumn("label", (F.col("x") > 15).cast("double"))
    ready = models.feature_vector(rows, ["x", "z"]).withColumn("train", models.split(None, ["id"]))
    train, test = ready.where("train"), ready.where("NOT train")
    assert 0.7 < train.count() / 400 < 0.9
    forest = models.forest_regressor(trees=20, depth=6, features="all", label="y").fit(train)
    base = test.crossJoin(train.agg(F.avg("y").alias("p")))
    assert models.error_metrics(forest.transform(test), "y", "prediction").first()["mae"] < 0.3 * models.error_metrics(base, "y", "p").first()["mae"]
    table = models.importance_table(forest, ["x", "z"], spark).collect()
    assert table[0]["feature"] == "x" and math.isclose(sum(r["importance"] for r in table), 1.0)
    weights = models.balanced_weights(train)
    sums = {r["label"]: r["s"] for r in weights.groupBy("label").agg(F.sum("weight").alias("s")).collect()}
    assert math.isclose(sums[0.0], sums[1.0])
    scored = models.forest_classifier(trees=10, depth=4).fit(weights).transform(test)
    scored = scored.select("label", models.positive_probability(scored).alias("score"))
    assert scored.where("score < 0 OR score > 1").count() == 0
    fitted = models.platt(scored, "score")
    # at the optimum the penalised gradient vanishes
    b, a, n = float(fitted.coefficients[0]), float(fitted.intercept), scored.count()
    p = 1 / (1 + F.exp(-(F.col("score") * b + a)))
    g = scored.agg(F.sum((p - F.col("label")) * F.col("score")).alias("g"), F.sum(p - F.col("label")).alias("h")).first()
    assert abs(g["g"] / n + b / n) < 1e-3 and abs(g["h"] / n) < 1e-3
    assert models.brier(scored, "label", "score").first()["brier"] < 0.05
    out, failed = models.model_grid(rows.withColumn("GW", (F.col("id") % 10).cast("int")), {"bad": lambda: 1 / 0}, ["y"], [5], [1], ["x"])
    assert out is None and len(failed) == 1


def test_small_helpers(spark):
    df = spark.createDataFrame([("1", 1), ("x", 2)], "a string, GW int")
    assert [r["a"] for r in clean.coerce_numeric(df, ["a"]).collect()] == [1.0, None]
    assert clean.available(df, ["a", "b"]) == ["a"] and clean.columns_like(df) == ["GW"]
    assert {tuple(r) for r in clean.one_hot(df, "nope", {"f": "v"}).select("f").collect()} == {(0,)}
    assert report.formation(spark.createDataFrame([("DEF",), ("MID",), ("DEF",)], "position string")).first()[0] == "2-1-0"
