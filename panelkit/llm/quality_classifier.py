"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Cosines of random projections approximate a Gaussian kernel over standardised statistics. Tasks sum the normal equations
of their labelled rows by fold; the sums, whose size does not depend on the rows, are added and solved once. As the
equations of any folds are a difference of sums, scores of rows that a fit has not seen come without further passes:
they choose the ridge penalty and carry the isotonic calibration.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.shared import saved

SYMBOLS = b"#*$%&|<>"
VOWELS = b"aeiouAEIOU"
#: Size of the approximation and width of the kernel, in units of the root of the number of statistics.
FEATURES, WIDTH, SEED = 512, 1.5, 13
#: Ridge penalties that are tried, as shares of the rows.
PENALTIES = (1e-6, 1e-5, 3e-5, 1e-4, 1e-3, 1e-2)
#: Rows of a task that sums normal equations.
ROWS_PER_SUM = 25_000
#: Buckets of raw scores in which isotonic regression pools, over scores from LOW to HIGH.
BUCKETS, LOW, HIGH = 4096, -0.5, 1.5
#: Share of the raw score in the calibrated one, so that equal calibrated scores keep their order.
ORDER = 0.01
THRESHOLD = 0.3
FOLDS = 5

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "spread_word", "longest_word", "upper_share", "digit_share", "symbol_share", "blank_share", "breaks_per_word", "wide_share",
    "mark_share", "entropy", "distinct_words", "repeated_grams", "log_lines", "log_line_words", "repeated_lines", "vowel_share", "capital_words",
    "doubled_words", "short_words", "ends_per_word", "shouts_per_word", "commonest_word", "title_words", "plain_words", "symbol_words")


def _sum(h: np.ndarray, chars: bytes) -> int:
    return int(h[list(chars)].sum())


def statistics(text: bytes) -> list[float]:
    """The numbers that a text is judged by, in the order of ``STATISTICS``; zeros for a text without bytes."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    h = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    m = len(words)
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, m)
    sizes = np.fromiter(map(len, words), np.int64, m) if m else np.zeros(1, np.int64)
    per_word, wide = max(m, 1), len(number) + 1
    grams = (codes[:-2] * wide + codes[1:-1]) * wide + codes[2:] if m > 2 and wide < 2**21 else codes
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    upper, lower = int(h[65:91].sum()), int(h[97:123].sum())
    marks = int(h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum())
    share = h[h > 0] / n
    capital = title = plain = symbol = 0
    counts = np.bincount(codes, minlength=1)
    for w, c in zip(number, counts.tolist()):  # each distinct word once
        if w.isupper():
            capital += c
        elif w[:1].isupper():
            title += c
        if w.isalpha():
            plain += c
        elif w.translate(None, SYMBOLS) != w:
            symbol += c
    return [
        math.log1p(n), math.log1p(m), float(sizes.mean()), float(sizes.std()), math.sqrt(float(sizes.max())), upper / max(upper + lower, 1), int(h[48:58].sum()) / n,
        _sum(h, SYMBOLS) / n, int(h[32] + h[9:14].sum()) / n, int(h[10]) / per_word, int(h[128:].sum()) / n, marks / n, float(-(share * np.log2(share)).sum()),
        len(number) / per_word**0.9, 1 - len(np.unique(grams)) / max(len(grams), 1), math.log1p(len(lines)), math.log1p(m / n_lines), 1 - len(set(lines)) / n_lines,
        _sum(h, VOWELS) / max(upper + lower, 1), capital / per_word, int((codes[1:] == codes[:-1]).sum()) / per_word, float((sizes <= 3).sum()) / per_word,
        _sum(h, b".!?") / per_word, _sum(h, b"!") / per_word, float(counts.max()) / per_word, title / per_word, plain / per_word, symbol / per_word]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``statistics`` (array of doubles) of each whole text; null counts as empty."""
    def run(batches):
        for b in batches:
            rows = [statistics(t.as_py() or b"") for t in b.column(1).cast(pa.binary())]
            flat = pa.array(np.array(rows, np.float64).ravel() if rows else np.zeros(0))
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(flat, len(STATISTICS))], names=["doc_id", "statistics"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, statistics array<double>")


def _lists(flat: pa.Array, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), flat)


def _rows(column) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id has no number and lies in fold 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)), F.lit(1)).cast("int")


@dataclass
class Fourier:
    """Standardised statistics to cosines: products of two rows' cosines approximate a Gaussian kernel."""

    mean: np.ndarray
    spread: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray

    @classmethod
    def drawn(cls, mean, spread, features: int = FEATURES, width: float = WIDTH, seed: int = SEED) -> Fourier:
        r, n = np.random.default_rng(seed), len(mean)
        spread = np.where(np.asarray(spread, float) > 1e-12, spread, 1.0)
        return cls(np.asarray(mean, float), spread, r.normal(size=(n, features)) / (width * math.sqrt(n)), r.uniform(0, 2 * math.pi, features))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Cosines and a last column of ones; values beyond five spreads count as five."""
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        z = np.cos(z @ self.frequency + self.phase) * math.sqrt(2 / len(self.phase))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def normal_equations(rows: DataFrame, fourier: Fourier, tasks: int) -> dict[int, np.ndarray]:
    """fold -> [Z | y]'[Z | y] of rows (statistics, label, fold): summed in tasks, then by (fold, line of the matrix)."""
    size = len(fourier.phase) + 2

    def sums(batches):
        total = {}
        for b in batches:
            x, label, folds = _rows(b.column(0)), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            zy = np.concatenate([fourier(x), label[:, None]], axis=1) if b.num_rows else np.zeros((0, size))
            for f in np.unique(folds).tolist():
                part = zy[folds == f]
                total[f] = total.get(f, 0) + part.T @ part
        for f, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * size, pa.int32()), pa.array(range(size), pa.int32()), _lists(pa.array(m.ravel()), size)], names=["fold", "line", "v"])

    def add(table):
        v = _rows(table.column("v").combine_chunks()).sum(axis=0)
        return pa.table({"fold": table.column("fold")[:1], "line": table.column("line")[:1], "v": _lists(pa.array(v), size)})

    schema = "fold int, line int, v array<double>"
    parts = rows.select("statistics", "label", "fold").coalesce(tasks).mapInArrow(sums, schema)
    out = {}
    for r in parts.groupBy("fold", "line").applyInArrow(add, schema).collect():  # folds x size rows, whatever the input
        out.setdefault(r["fold"], np.zeros((size, size)))[r["line"]] = r["v"]
    return out


def ridge(m: np.ndarray, penalty: float) -> np.ndarray:
    """Weights from summed normal equations; the constant's weight is not penalised, the penalty is a share of the rows."""
    a, c, n = m[:-1, :-1].copy(), m[:-1, -1], m[-2, -2]
    a[np.diag_indices(len(a) - 1)] += penalty * max(n, 1.0)
    return np.linalg.lstsq(a, c, rcond=None)[0]


def squared_error(m: np.ndarray, w: np.ndarray) -> float:
    """Sum of squared errors of the weights on the rows that ``m`` sums up."""
    return float(m[-1, -1] - 2 * w @ m[:-1, -1] + w @ m[:-1, :-1] @ w)


def fit_ridge(sums: dict[int, np.ndarray], penalties=PENALTIES) -> tuple[float, np.ndarray, dict[int, np.ndarray]]:
    """(penalty with the least error on rows of other folds, weights of all folds, weights that leave out a fold)."""
    whole = sum(sums.values())
    if len(sums) < 2:
        w = ridge(whole, penalties[-1])
        return penalties[-1], w, {f: w for f in sums}
    tried = [(p, {f: ridge(whole - m, p) for f, m in sums.items()}) for p in penalties]
    best, left_out = min(tried, key=lambda t: sum(squared_error(m, t[1][f]) for f, m in sums.items()))
    return best, ridge(whole, best), left_out


def isotonic(x: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over groups by ascending ``x`` with ``n`` rows and ``total`` labels: mean x and level of each block."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x.tolist(), n.tolist(), total.tolist()):
        blocks.append([a * b, b, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], top)]
    b = np.array(blocks).reshape(-1, 3)
    return b[:, 0] / b[:, 1], b[:, 2] / b[:, 1]


@dataclass
class Model:
    fourier: Fourier
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):  # nothing to learn from
            return np.full(len(x), 0.5)
        raw = self.fourier(x) @ self.weights
        order = (np.clip(raw, LOW, HIGH) - LOW) / (HIGH - LOW)
        return np.clip((1 - ORDER) * np.interp(raw, self.knots, self.levels) + ORDER * order, 0.0, 1.0)


def fit(rows: DataFrame, mean, spread, features: int = FEATURES, width: float = WIDTH, seed: int = SEED) -> Model:
    """Model of rows (statistics, label 0 to 1, fold)."""
    fourier = Fourier.drawn(mean, spread, features, width, seed)
    n = rows.count()
    if not n:
        return Model(fourier, np.zeros(features + 1), np.zeros(0), np.zeros(0))
    sums = normal_equations(rows, fourier, max(8, -(-n // ROWS_PER_SUM)))
    _, weights, left_out = fit_ridge(sums)

    def unseen(batches):
        for b in batches:
            z, folds = fourier(_rows(b.column(0))) if b.num_rows else np.zeros((0, features + 1)), b.column(2).to_numpy(zero_copy_only=False)
            raw = np.zeros(b.num_rows)
            for f in np.unique(folds).tolist():
                raw[folds == f] = z[folds == f] @ left_out[f]
            bucket = np.clip((raw - LOW) / (HIGH - LOW) * BUCKETS, 0, BUCKETS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(raw), b.column(1)], names=["bucket", "raw", "label"])

    seen = rows.select("statistics", "label", "fold").mapInArrow(unseen, "bucket int, raw double, label double").groupBy("bucket").agg(
        F.count("*").alias("n"), F.avg("raw").alias("raw"), F.sum("label").alias("total")).orderBy("bucket").collect()  # at most BUCKETS rows
    x, k, total = (np.array([r[c] for r in seen], float) for c in ("raw", "n", "total"))
    return Model(fourier, weights, *isotonic(x, k, total))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD, features: int = FEATURES,
                   width: float = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every row of ``docs``.

    Scores come from the whole text's ``statistics`` alone. Labels of all rows outside fold 0 are learnt, none is
    sampled; means and spreads are those of all documents. Isotonic regression pools out-of-fold scores in ``BUCKETS``
    buckets; between blocks the calibration is linear.

    Null and empty texts have statistics of 0 and a score like others. A null label, and a label whose id no document
    has, teach nothing; several labels of an id count as their mean; repeated documents are rows of their own, each with the
    label. Null ids are scored, not held out, and have no label. Other columns are ignored. Without labels every score is
    0.5; no documents give no rows. Equal texts have equal scores; a long text is held by one task, with about 300 bytes a word.
    """
    known = saved(document_statistics(docs), "statistics")
    x = F.col("statistics")
    moments = known.agg(*[f(x[i]).alias(f"{k}{i}") for k, f in (("m", F.avg), ("s", F.stddev_pop)) for i in range(len(STATISTICS))]).first()
    mean, spread = ([moments[f"{k}{i}"] or 0.0 for i in range(len(STATISTICS))] for k in "ms")
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("label")).where(F.col("label").isNotNull())
    marks = marks.groupBy("_id").agg(F.avg("label").alias("label")).where(F.col("_id").isNotNull() & (fold(F.col("_id")) != 0))
    model = fit(known.join(marks, F.col("doc_id") == F.col("_id")).select("statistics", "label", fold(F.col("doc_id")).alias("fold")),
                mean, spread, features, width, seed)

    def run(batches):
        for b in batches:
            s = model.scores(_rows(b.column(1))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    scored = known.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) == 0)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_scores(docs, labels)
