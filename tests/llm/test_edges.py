"""Very long texts, and the stages on nulls, empty texts, repeated rows and empty tables."""

import pytest
from pyspark.sql import functions as F

from panelkit.llm import best_fit_packing, decontamination, line_dedup, quality_rules, secret_scan, simhash_dedup, tokens, url_filter

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 5000} and the other{i % 77}" for i in range(60_000))  # over a megabyte


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_long_texts_are_measured_whole(spark):
    got = quality_rules.quality_rules(docs_of(spark, [(1, LONG), (2, LONG + " !" * 300_000)])).select("row.doc_id", "measures.*", "kept", "failed").collect()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_words"] == 240_000 and by[1]["word_chars"] == len(LONG.replace(" ", "")) and by[2]["n_exclamations"] == 300_000
    assert by[1]["n_dup_lines"] == 0 and "exclamations" in by[2]["failed"]


def test_long_texts_have_one_fingerprint(spark):
    rows = [(1, LONG), (2, LONG), (3, LONG + " end"), (4, "short text here")]
    got = {r["doc_id"]: r["component_id"] for r in simhash_dedup.simhash_dedup(docs_of(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_secrets_at_the_end_of_long_texts(spark):
    text = LONG + " password=hunter22hunter"
    got = secret_scan.secret_scan(docs_of(spark, [(1, text), (2, LONG)])).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*").collect()
    assert [(r["doc_id"], r["kind"], text[r["start"]:r["stop"]]) for r in got if r["kind"] == "assign"] == [(1, "assign", "password=hunter22hunter")]


def test_long_texts_are_cut_into_full_pieces(spark):
    n = len(tokens.ids_of(tokens.default_path(), LONG, 0))
    got = best_fit_packing.best_fit_packing(docs_of(spark, [(1, LONG), (2, None)])).where("doc_id = 1").orderBy("piece").collect()
    assert sum(r["length"] for r in got) == n and {r["length"] for r in got[1:]} == {2048} and [r["start"] for r in got] == [0, *[n % 2048 + 2048 * k for k in range(n // 2048)]]


def test_passages_at_the_end_of_long_texts(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").orderBy("item_id")
    item = bench.first()
    got = decontamination.benchmark_overlaps(docs_of(spark, [(1, LONG + " " + item["text"]), (2, LONG)]), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= {(1, item["item_id"])} and not any(r["doc_id"] == 2 for r in got)


def test_lines_of_long_texts(spark):
    rows = [(i, "\n".join(f"line {chr(97 + i)} number {j} of {i} " + "xy"[j % 2] * (i + 1) for j in range(5000)) + "\nThe same closing line everywhere") for i in range(10)]
    got = line_dedup.line_dedup(docs_of(spark, rows)).collect()
    assert all(r["n_lines"] == 5001 and "closing" not in r["text"] for r in got)


def test_long_urls(spark):
    rows = [(1, "http://" + "blue" * 500 + ".example.org/" + "path/" * 2000, "<p>blue sky</p>"), (2, "http://a.net/es/x", None), (3, "https://b.com/" + "y" * 10_000 + "?q", "")]
    got = {r["page_id"]: r for r in url_filter.url_filter(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got[1]["host"]) == 2012 and len(got[1]["path"]) == 10_001 and got[2]["verdict"] == "block" and got[3]["rule"] == "com/"


@pytest.fixture(scope="module")
def odd(spark):
    text = "The quick and the slow are of one mind, and that is as it should be for all of us in the end. " * 8
    text = " ".join(f"{w}{i}" if i % 3 else w for i, w in enumerate(text.split()))
    rows = [(1, text, 5, 0), (1, text, 5, 0), (1, "other words " + text[::-1], 5, 1), (None, text + " more", 5, 2), (None, None, None, 3), (7, None, 0, 4), (8, "", 0, 5), (9, " \n ", 3, 6)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int, kept int")


def test_quality_stage_on_odd_rows(spark, odd):
    out = quality_rules.quality_stage(spark, odd, SF)
    assert out.columns == odd.columns and sorted(r["kept"] for r in out.collect() if r["text"] and "quick" in r["text"]) == [0, 0, 2]
    assert not any(r["text"] is None or not r["text"].strip() for r in out.collect()) and quality_rules.quality_stage(spark, odd.limit(0), SF).count() == 0


def test_line_stage_on_odd_rows(spark, odd):
    out = line_dedup.line_stage(spark, odd, SF)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    assert sorted(map(str, (r["text"] for r in out.collect()))) == sorted(map(str, (r["text"] for r in odd.collect())))
    assert {r["n_chars"] for r in out.where("text IS NULL").collect()} == {None} and line_dedup.line_stage(spark, odd.limit(0), SF).count() == 0


def test_simhash_stage_on_odd_rows(spark, odd):
    out = simhash_dedup.simhash_stage(spark, odd, SF)
    # the near copy without an id and all blank texts but one go; rows of one id stay together
    assert out.columns == odd.columns and sorted(r["kept"] for r in out.collect()) == [0, 0, 1, 4]
    assert simhash_dedup.simhash_stage(spark, odd.limit(0), SF).count() == 0


def test_decontamination_stage_on_odd_rows(spark, odd):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = odd.union(spark.createDataFrame([(None, item, 1, 7), (20, item, 1, 8)], odd.schema))
    out = decontamination.decontamination_stage(spark, rows, SF)
    assert out.columns == odd.columns and sorted(r["kept"] for r in out.collect()) == [0, 0, 1, 4, 5, 6]
    assert decontamination.decontamination_stage(spark, odd.limit(0), SF).count() == 0


def test_packing_stage_on_odd_rows(spark, odd):
    out = best_fit_packing.packing_stage(spark, odd, SF).collect()
    assert len(out) == odd.count() and sorted(r["length"] for r in out)[:3] == [1, 1, 1]
    assert best_fit_packing.packing_stage(spark, odd.limit(0), SF).count() == 0
