"""Quality classifier: its parts against plain NumPy, held-out accuracy, hard rows."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return float(np.mean([(pos > x).mean() + 0.5 * (pos == x).mean() for x in neg]))


@pytest.fixture(scope="module")
def judged(spark):
    return {r["doc_id"]: r for r in qc.op13_quality_classifier(spark, SF).collect()}


def test_held_out_labels_are_told_apart(spark, judged):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = [i for i in judged if i in label and judged[i]["held_out"]]
    assert len(ids) > 50 and all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)
    y, s = np.array([label[i] for i in ids]), np.array([judged[i]["score"] for i in ids])
    assert auc(s, y) > 0.98 and (np.array([judged[i]["predicted"] for i in ids]) == y).mean() > 0.95
    assert ((s - y) ** 2).mean() < 0.05


def test_all_documents_are_judged(spark, judged):
    ids = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(judged) == sorted(ids)
    for i, r in judged.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_held_out_labels_teach_nothing(spark, judged):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(qc.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    got = {r["doc_id"]: r["score"] for r in qc.quality_scores(docs.select("doc_id", "text"), turned).collect()}
    assert max(abs(got[i] - r["score"]) for i, r in judged.items()) < 1e-6


def test_sums_equal_plain_numpy(spark):
    r = np.random.default_rng(1)
    x, y, f = r.normal(size=(300, 5)), r.random(300), r.integers(1, 5, 300)
    rows = spark.createDataFrame([(v.tolist(), float(a), int(b)) for v, a, b in zip(x, y, f)], "statistics array<double>, label double, fold int").repartition(7)
    fourier = qc.Fourier.drawn(x.mean(0), x.std(0), 40)
    sums = qc.normal_equations(rows, fourier, 3)
    z = fourier(x)
    for k in range(1, 5):
        m = np.concatenate([z[f == k], y[f == k, None]], axis=1)
        assert np.allclose(sums[k], m.T @ m)
    penalty, w, left_out = qc.fit_ridge(sums)
    eye = np.eye(41) * penalty * 300
    eye[-1, -1] = 0
    assert np.allclose(w, np.linalg.solve(z.T @ z + eye, z.T @ y), atol=1e-6)
    errors = []
    for p in qc.PENALTIES:
        total = 0
        for k in range(1, 5):
            a, n = z[f != k], (f != k).sum()
            e = np.eye(41) * p * n
            e[-1, -1] = 0
            u = np.linalg.solve(a.T @ a + e, a.T @ y[f != k])
            total += ((z[f == k] @ u - y[f == k]) ** 2).sum()
            if p == penalty:
                assert np.allclose(u, left_out[k], atol=1e-5)
        errors.append(total)
    assert qc.PENALTIES[int(np.argmin(errors))] == penalty


def test_cosines_approximate_the_gaussian_kernel():
    r = np.random.default_rng(2)
    x = r.normal(size=(30, 4))
    z = qc.Fourier.drawn(np.zeros(4), np.ones(4), 20_000)(x)[:, :-1]
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-d / (2 * 4 * qc.WIDTH**2))).max() < 0.05


def test_isotonic_equals_the_minimax_formula():
    r = random.Random(3)
    for _ in range(100):
        k = r.randint(1, 12)
        x, n = np.arange(k, dtype=float), np.array([r.randint(1, 5) for _ in range(k)], float)
        total = np.array([r.randint(0, int(v)) for v in n], float)
        knots, levels = qc.isotonic(x, n, total)
        # the least-squares monotone fit: the largest over starts of the smallest mean over ends
        want = [max(min(total[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, k)) for a in range(i + 1)) for i in range(k)]
        assert np.allclose(sorted(set(np.round(want, 9))), np.round(levels, 9)) and (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()


def test_statistics_of_hard_texts():
    n = len(qc.STATISTICS)
    assert qc.statistics(b"") == [0.0] * n
    for t in (b" \n\t", b"a", "é 漢 😀".encode(), b"a" * 2_000_000, b"x " * 500_000, b"\x00\n" * 10):
        got = qc.statistics(t)
        assert len(got) == n and all(math.isfinite(v) for v in got)
    by = dict(zip(qc.STATISTICS, qc.statistics(b"The THE the! a b.\nThe THE the! a b.\n")))
    assert by["repeated_lines"] == 0.5 and by["capital_words"] == 0.2 and by["title_words"] == 0.2 and by["ends_per_word"] == 0.4 and by["shouts_per_word"] == 0.2
    assert by["repeated_grams"] == 1 - 5 / 8 and by["commonest_word"] == 0.2 and by["mean_word"] == 2.6


def test_hard_rows(spark, corpus):
    sf, rows = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("statistics", F.lit(1)).withColumn("label", F.lit(2)).withColumn("fold", F.lit("x"))
    kinds = "doc_id bigint, quality int, statistics int, fold string"
    marks = [(i, int(len(t or "") > 300), 1, "y") for i, t in rows if i is not None] + [(None, 1, 1, "y"), (3, None, 1, "y"), (10**9, 0, 1, "y"), (5, 0, 1, "y"), (5, 1, 1, "y")]
    got = qc.quality_scores(docs, spark.createDataFrame(marks, kinds)).collect()
    assert sorted((str(r["doc_id"]) for r in got)) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in got) and [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    # without labels, with labels of one kind, without documents
    none = qc.quality_scores(docs, spark.createDataFrame([], kinds)).collect()
    assert len(none) == len(rows) and {r["score"] for r in none} == {0.5}
    one = qc.quality_scores(docs, spark.createDataFrame([(1, 1, 0, "")], kinds)).collect()
    assert len(one) == len(rows) and all(r["predicted"] == 1 for r in one)
    assert qc.quality_scores(docs.limit(0), spark.createDataFrame(marks, kinds)).count() == 0
