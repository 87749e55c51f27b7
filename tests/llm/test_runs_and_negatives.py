"""Periodic runs and hard negatives against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelkit.llm import hard_negatives, periodic_runs

BLANK = re.compile(r"[\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


# --- 11
def plain_runs(w, shortest=6, exponent=4):
    out = set()
    for q in range(1, len(w) // exponent + 1):
        s = 0
        while s + q < len(w):
            e = s
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            n = e - s + q
            if e > s and n >= max(shortest, exponent * q):
                part = w[s:s + n]
                if all(part[:-p] != part[p:] for p in range(1, q)):
                    out.add((s, n, q))
            s = max(e, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def coded(w):
    return [b"%d" % x for x in w]


@pytest.mark.parametrize("shortest,exponent", [(6, 4), (2, 2), (6, 3), (1, 4), (9, 2)])
def test_runs_equal_brute_force(shortest, exponent):
    r = random.Random(shortest * 10 + exponent)
    for _ in range(500):
        k, n = r.randint(1, 4), r.randint(0, 50)
        w = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.6:
            at, p = r.randint(0, n), r.randint(1, 8)
            w[at:at] = ([r.randrange(k) for _ in range(p)] * 12)[:r.randint(0, 60)]
        want = plain_runs(w, shortest, exponent)
        assert sorted(periodic_runs.runs(w, shortest, exponent), key=lambda x: (x[0], x[2])) == want
        assert periodic_runs.text_runs(coded(w), shortest, exponent) == want


def test_stretches_hold_every_run_and_little_else():
    r = random.Random(2)
    w = [r.randrange(3000) for _ in range(4000)]
    w[1000:1000] = w[200:230] * 5
    w[3000:3000] = [7] * 9
    found = periodic_runs.stretches(np.array(w))
    for s, n, _ in plain_runs(w):
        assert any(a <= s and s + n <= b for a, b in found)
    assert sum(b - a for a, b in found) < 400


def test_last_ends_equal_a_plain_table():
    """Each segment's colour is the last end of its deepest state's string."""
    r = random.Random(3)
    for _ in range(60):
        w = [r.randrange(3) for _ in range(r.randint(1, 40))]
        tree = periodic_runs.Automaton(w)
        ends, seen = periodic_runs.LastEnds(tree.link), {}
        for i, v in enumerate(tree.prefix):
            parts, x, want = ends.access(v, i), v, []
            assert parts[0][0] == v
            while x:
                if not want or seen.get(x, -1) != want[-1][1]:
                    want.append((x, seen.get(x, -1)))
                seen[x] = i
                x = tree.link[x]
            # neighbouring segments of one colour may be apart or joined
            merged = [p for n, p in enumerate(parts) if not n or p[1] != parts[n - 1][1]]
            assert merged == want


def plain_row(i, text):
    w = [x for x in BLANK.split(text or "") if x]
    h, n = zlib.crc32(str(i).encode()), len(w)
    if i is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if j < a else w[a + (j - a) % p] for j, x in enumerate(w)]
    numbers = {x: j for j, x in enumerate(dict.fromkeys(w))}
    found = fast_plain_runs([numbers[x] for x in w])
    gone = {j for s, m, q in found for j in range(s + q, s + m)}
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(found), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))


def fast_plain_runs(w, shortest=6, exponent=4):
    """All periods, one after the other, by numpy; a period is smallest if no divisor of it has the same stretch."""
    a, found = np.array(w), {}
    for q in range(1, len(w) // exponent + 1):
        same = np.concatenate([[0], (a[q:] == a[:-q]).astype(int), [0]])
        turn = np.flatnonzero(np.diff(same))
        for s, e in zip(turn[::2].tolist(), turn[1::2].tolist()):
            if e - s + q >= max(shortest, exponent * q):
                if not any(q % p == 0 and (s, e - s + q) in found.get(p, ()) for p in range(1, q)):
                    found.setdefault(q, set()).add((s, e - s + q))
    return sorted(((s, n, q) for q, rows in found.items() for s, n in rows), key=lambda r: (r[0], r[2]))


def test_periodic_runs_of_documents(spark, corpus):
    sf, rows = corpus
    got = [tuple(r) for r in periodic_runs.op11_periodic_runs(spark, sf).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*r) for r in rows), key=str)
    assert sum(r[1] for r in got) > 20 and None in {r[0] for r in got}


def test_runs_of_hard_texts(spark):
    long = "x " * 200_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b " * 10), (4, "a b " * 10), (4, "a b " * 10), (5, long), (6, "q r " * 8), (7, "a " * 5), (8, "a " * 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "1 AS runs", "text", "2 AS n_words", "3 AS collapsed")
    got = {(r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in periodic_runs.periodic_runs(docs).collect()}
    assert got == {(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (None, 20, ((0, 20, 2),), "a b"), (4, 20, ((0, 20, 2),), "a b"),
                   (5, 200_000, ((0, 200_000, 1),), "x"), (6, 8, ((0, 8, 1),), "q r"), (7, 5, (), "a a a a a"), (8, 6, ((0, 6, 1),), "a")}
    assert periodic_runs.periodic_runs(docs).count() == len(rows)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# --- 12
def plain_negatives(rows, positives=5, negatives=5):
    """rows: (id, label, vector)"""
    ok = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, l, v in rows
          if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    most = 2**63 - 1
    dot = lambda a, b: max(-most, min(most, sum(x * y for x, y in zip(a, b))))
    out = []
    for a, la, va in {(i, l, tuple(v)) for i, l, v in ok if i % 100 == 0}:
        scored = sorted((-dot(va, v), i, l) for i, l, v in ok)
        near = [(-s, i) for s, i, l in scored if l == la and i != a][:positives]
        for ps, p in near:
            hits = [(-s, i) for s, i, l in scored if l != la and 80 * ps <= -100 * s <= 100 * ps][:negatives]
            out += [(a, p, n + 1, i, ps, s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def relabelled(rows):
    return [(i, (l + 1) % 10 if i is not None and l is not None and i % 7 == 0 else l, v) for i, l, v in rows]


def mined(spark, tmp_path, rows, **kw):
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[2] for r in rows], pa.list_(pa.float32())),
                      "label": pa.array([r[1] for r in rows], pa.int32()), "score": list(range(len(rows))), "anchor": ["x"] * len(rows)})
    pq.write_table(table, f"{tmp_path}/embeddings.parquet", row_group_size=max(1, len(rows) // 5))
    return sorted(tuple(r) for r in hard_negatives.op12_hard_negatives(spark, str(tmp_path)).collect())


def test_hard_negatives_of_embeddings(spark):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain_negatives(relabelled(rows))
    got = hard_negatives.op12_hard_negatives(spark, SF)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_hard_negatives_with_ties_and_hard_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SCORES_AT_ONCE", 100)
    r = random.Random(4)
    rows = [(i, r.randrange(3), [r.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)]) for i in range(420)]
    rows += [(i, 1, [0.5, 0.5, 0.5, 0.5]) for i in range(500, 640)]  # one common vector
    rows += [(None, 1, [1.0] * 4), (700, None, [1.0] * 4), (701, 1, None), (702, 1, [1.0, None, 0.0, 0.0]), (703, 2, [float("nan")] * 4),
             (704, 2, [float("inf")] * 4), (705, 1, [1.0, 0.5]), (706, 2, []), (800, 5, []), (707, 2, [1.0] * 6), (900, 1, [1.0] * 6), (-100, 2, [0.5] * 4),
             (12, 0, [1.0] * 4), (12, 0, [1.0] * 4), (13, 2, [0.5] * 4), (13, 2, [0.5] * 4), (13, 1, [0.5] * 4), (100, 2, [1.0, 0.0, 0.0, 0.5]), (1000, 9, [-1.0] * 4), (1001, 9, [1.0] * 4)]
    r.shuffle(rows)
    want = plain_negatives(relabelled(rows))
    assert mined(spark, tmp_path, rows) == want and len(want) > 100


def test_hard_negatives_of_huge_components(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, r.randrange(2), [r.choice([1e3, 3e8, -2e9, 1e20, 3e38]) * r.random() for _ in range(3)]) for i in range(150)]
    assert mined(spark, tmp_path, rows) == plain_negatives(relabelled(rows))


def test_blocks_of_anchors_give_the_same(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("vec_id AS id", "label", "embedding AS vector")
    got = [sorted(tuple(r) for r in hard_negatives.hard_negatives(e, F.col("id") % 20 == 0, positives=3, negatives=2, low=50, anchors_per_block=n).collect()) for n in (20_000, 6)]
    assert got[0] == got[1] and got[0]


def test_no_embeddings(spark, tmp_path):
    assert mined(spark, tmp_path, []) == []
