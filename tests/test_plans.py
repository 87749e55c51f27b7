"""Plans that must hold at scale: no nested loops but for one-row tables, no window over one partition, no Python."""

import io
from contextlib import redirect_stdout

import pytest

from panelkit.plans import catalogue
from panelkit.operators import clean

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.mark.parametrize("name", ["fixture_attach", "strength_join", "outer_merge_points", "rolling3", "quota_topk", "best_xi", "backtest_mean", "bins_explicit"])
def test_no_nested_loops_or_python(spark, name):
    text = plan_of(catalogue.queries()[name](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "ArrowEval"):
        assert bad not in text, bad
    for line in text.split("\n"):
        assert not ("Exchange SinglePartition" in line and "quota" in name)


def test_quota_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(catalogue.queries()["quota_topk"](spark, SF))


def test_period_slice_prunes_partitions(spark, tmp_path):
    spark.range(40).selectExpr("id", "CAST(id % 10 AS INT) AS GW").write.partitionBy("GW").parquet(str(tmp_path / "p"))
    text = plan_of(clean.period_slice(spark.read.parquet(str(tmp_path / "p")), 2, 3))
    assert "PartitionFilters: [isnotnull(GW" in text


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
