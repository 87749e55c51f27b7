"""CSV cells, sinks, snapshots, profiles and the stream."""

import csv
import io
import random
from contextlib import redirect_stdout
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from panelkit.plans import catalogue
from panelkit.sources import ingest
from panelkit.streaming import incremental

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


# --- cells
def python_cells(line):
    return next(csv.reader([line]), [])


def test_cells_equal_pythons_reader(spark):
    r = random.Random(1)
    lines = ["", "a", '"a""b,c",1', r'"a\"b,c",1', 'a"b,c', '"a"b,c', '"abc,d', '"', '""', '"",""', ",", ',,"x"', '"a" "b",c', '""""', '"""a""",b', ' "a,b",c', 'é,"漢,字"', "a\tb,c",
             '"' + "x" * 50_000 + '""' * 5_000 + '",1']
    lines += ["".join(r.choice('ab",, "') for _ in range(r.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([*enumerate(lines), (-1, None)], "i int, v string")
    got = {x["i"]: x["c"] for x in df.select("i", ingest.cells(F.col("v")).alias("c")).collect()}
    assert got.pop(-1) is None and all(got[i] == python_cells(x) for i, x in enumerate(lines))


def test_quotes_do_not_shift_columns_and_are_counted_alike(spark):
    lines = ['"a""b,c",1', r'"a\"b,c",1', '"x,y",2', "z,3", 'q"r,4', "only", "", None, "u,,w", "s,"]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    got = {tuple(r) for r in ingest.parse_lines(df, "v", {2: ["n", "k"]}).collect()}
    assert got == {('a"b,c', "1"), ("x,y", "2"), ("z", "3"), ('q"r', "4"), ("s", None)}
    report = {r["arity"]: (r["n"], r["accepted"]) for r in ingest.ragged_report(df, "v", [2]).collect()}
    want = {}
    for x in lines:
        if x is not None:
            n = len(python_cells(x))
            want[n] = (want.get(n, (0,))[0] + 1, n == 2)
    assert report == want


@pytest.mark.parametrize("name", ["ragged_repair", "ragged_report", "scan_lines", "clean_fixtures"])
def test_lines_are_parsed_once(spark, name):
    assert plan_of(catalogue.queries()[name](spark, SF)).count("regexp_extract_all(") == 1


# --- snapshots and sinks
def test_the_newest_file_by_name(spark, tmp_path):
    df = spark.range(3)
    assert ingest.latest_named(spark, [str(tmp_path / "none")]) is None
    (tmp_path / "GW99").mkdir()
    (tmp_path / "GW99" / "empty").mkdir()
    df.write.parquet(str(tmp_path / "GW99" / "a" / "current.parquet"))
    for n in (9, 10, 2):
        df.withColumn("n", F.lit(n)).coalesce(1).write.parquet(str(tmp_path / "b" / f"GW{n}_Predicted_goals.parquet"))
    # a number in the folder's own path does not count
    got = ingest.latest_named(spark, [str(tmp_path / "GW99" / "empty"), str(tmp_path / "GW99" / "a"), str(tmp_path / "b")])
    assert {(r["n"], r["period"]) for r in got.collect()} == {(10, 10)} and got.count() == 3


def test_predictions_are_sorted_over_all_files_and_replaced(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i:03}", float(i % 7)) for i in range(200)] + [(500, "none", None)], "GW int, n string, x double").repartition(4)
    for part in (df.limit(10), df):
        ingest.write_predictions(part, str(tmp_path / "out"), ["n", "gone", "x"], ["-x", "n", "GW"], parts=3)
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    rows = [x for f in files for x in csv.reader(f.read_text().splitlines()[1:])]
    want = sorted(([f"n{i:03}", str(float(i % 7))] for i in range(200)), key=lambda r: (-float(r[1]), r[0]))
    assert len(files) > 1 and rows == [*want, ["none", ""]]


def test_periods_written_again_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(g, i, "old") for g in (1, 2, 3) for i in range(4)], "GW int, i int, v string")
    ingest.write_period_snapshots(df, path)
    new = spark.createDataFrame([(3, 9, "new"), (4, 9, "new")], "GW int, i int, v string")
    for _ in range(2):
        ingest.write_period_snapshots(new, path)
    got = sorted((r["GW"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "old")] * 4 + [(2, "old")] * 4 + [(3, "new"), (4, "new")]


def test_profile_of_every_kind_of_column(spark):
    rows = [(1, 2.5, "b", True, date(2024, 1, 2), datetime(2024, 1, 1, 0, 0, 1), [1]), (None, float("nan"), None, False, None, None, None), (-3, None, "a", None, date(1969, 12, 31), None, [])]
    df = spark.createDataFrame(rows, "i int, `d.x` double, s string, f boolean, day date, t timestamp, a array<int>")
    got = {r["column"]: r for r in ingest.profile(df).collect()}
    assert [got[c]["n_null"] for c in ("i", "d.x", "s", "f", "day", "t", "a")] == [1, 1, 1, 1, 1, 2, 1] and {r["n"] for r in got.values()} == {3}
    assert (got["i"]["lo"], got["i"]["hi"]) == (-3, 1) and got["d.x"]["lo"] == 2.5 and got["d.x"]["hi"] != got["d.x"]["hi"]
    assert (got["s"]["first"], got["s"]["last"], got["s"]["lo"]) == ("a", "b", None) and (got["f"]["lo"], got["f"]["hi"]) == (0, 1)
    assert got["day"]["lo"] == -86400 and got["t"]["lo"] == 1704067201 and got["a"]["kind"] == "array<int>"
    empty = {r["column"]: (r["n"], r["n_null"], r["lo"]) for r in ingest.profile(df.limit(0)).collect()}
    assert len(empty) == 7 and set(empty.values()) == {(0, 0, None)}


# --- stream
SCHEMA = "element int, fixture int, seq int, kickoff timestamp, GW int"


def lines_of(rows):
    return "element,fixture,seq,kickoff,GW\n" + "".join(f"{e},{f},{s},2024-01-{g:02} 10:00:00,{g}\n" for e, f, s, g in rows)


def test_stream_goes_on_after_restarts(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "target", "check"))
    (tmp_path / "in").mkdir()
    run = lambda: incremental.stream_panel(spark, source, SCHEMA, target, check, order="seq", row_keys=("element", "fixture", "seq")).awaitTermination()
    first = [(1, 1, 5, 1), (1, 1, 3, 1), (2, 1, 4, 1), (1, 2, 6, 2)]
    (tmp_path / "in" / "a.csv").write_text(lines_of(first))
    run()
    (tmp_path / "in" / "b.csv").write_text(lines_of([*first, (1, 2, 1, 2), (3, 3, 9, 3)]))  # an old key with a smaller seq comes too late
    run()
    run()  # nothing new
    (tmp_path / "in" / "c.csv").write_text(lines_of([(3, 3, 9, 3), (4, 3, 2, 3)]))
    run()
    got = sorted((r["element"], r["fixture"], r["seq"]) for r in spark.read.parquet(target).collect())
    assert got == [(1, 1, 3), (1, 2, 6), (2, 1, 4), (3, 3, 9), (4, 3, 2)]


def test_a_batch_is_appended_once(spark, tmp_path):
    target, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    rows = spark.createDataFrame([(1, 1, 1, datetime(2024, 1, 1), 1), (2, 1, 2, datetime(2024, 1, 1), 1)], SCHEMA)
    assert incremental.append_once(rows, 7, target, ledger, order="seq")
    assert not incremental.append_once(rows, 7, target, ledger, order="seq")
    # a driver lost between the append and the ledger's entry: the batch comes again and adds what is missing
    more = rows.union(spark.createDataFrame([(3, 1, 3, datetime(2024, 1, 1), 1)], SCHEMA))
    assert incremental.append_once(more, 8, target, ledger, order="seq")
    assert sorted(r["element"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_only_the_batchs_periods_are_read(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(40).selectExpr("id AS element", "id AS fixture", "CAST(id % 10 AS INT) AS GW").write.partitionBy("GW").parquet(target)
    batch = spark.createDataFrame([(1, 1, 3), (2, 2, 4)], "element int, fixture int, GW int")
    base = incremental.same_periods(spark, target, batch)
    assert base.count() == 8 and incremental.same_periods(spark, str(tmp_path / "none"), batch) is None
    out = io.StringIO()
    with redirect_stdout(out):
        base.explain("formatted")
    assert "PartitionFilters: [GW" in out.getvalue()
