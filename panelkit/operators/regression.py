"""Linear and ridge regression on several features, for all cells of a grid at once.

One scan sums the central cross products of features and target by cell; what is left of a cell is one row, whatever the
number of its rows, and is solved by itself. Nothing runs before the result is asked for.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.models import error_metrics


#: Tasks' sums are merged in so many groups first, then by cell.
MERGERS = 64


def _merged(n: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, means and covariances of the union of parts, each given by its own."""
    total = n.sum()
    m = (n[:, None] * mean).sum(axis=0) / total
    d = mean - m
    return int(total), m, ((n[:, None] * cov).sum(axis=0) + np.einsum("k,ki,kj->ij", n, d, d).ravel()) / total


def cross_products(df: DataFrame, features: list[str], target: str, keys: tuple = ()) -> DataFrame:
    """keys, n, means and covariances (row by row, target last) of the rows in which features and target are there.

    Tasks sum their rows as matrices about their own means and send one row for each cell; parts are merged in two steps,
    so precision does not suffer from means far from 0. Null keys are cells.
    """
    k, p = len(keys), len(features) + 1
    cols = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate([*features, target])]
    rows = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], *cols).dropna(subset=[f"_x{i}" for i in range(p)])
    kinds = "".join(f"_k{i} {rows.schema[f'_k{i}'].dataType.simpleString()}, " for i in range(k))
    schema = f"{kinds}_part int, n bigint, means array<double>, cov array<double>"
    names = [*[f"_k{i}" for i in range(k)], "_part", "n", "means", "cov"]

    def sums(batches):
        parts: dict = {}
        types = []
        for b in batches:
            types = [b.column(i).type for i in range(k)]
            if not b.num_rows:
                continue
            x = np.stack([b.column(k + i).to_numpy(zero_copy_only=False) for i in range(p)], axis=1)
            code = np.zeros(b.num_rows, np.int64)
            for i in range(k):
                d = b.column(i).dictionary_encode()
                code = code * (len(d.dictionary) + 1) + d.indices.fill_null(len(d.dictionary)).to_numpy(zero_copy_only=False)
            _, first, cell = np.unique(code, return_index=True, return_inverse=True)
            for c, at in enumerate(first.tolist()):
                key, part = tuple(b.column(i)[at].as_py() for i in range(k)), x[cell == c]
                mean = part.mean(axis=0)
                here = (np.array([len(part)]), mean[None], ((part - mean).T @ (part - mean) / len(part)).reshape(1, -1))
                if key in parts:
                    n, m, v = parts[key]
                    here = (np.append(here[0], n), np.vstack([here[1], m]), np.vstack([here[2], v]))
                parts[key] = _merged(*here)
        if parts:
            task = TaskContext.get().partitionId() % MERGERS
            key = list(zip(*parts)) if k else []
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(key[i], types[i]) for i in range(k)], pa.array([task] * len(parts), pa.int32()), pa.array([v[0] for v in parts.values()], pa.int64()),
                 pa.array([v[1].tolist() for v in parts.values()]), pa.array([v[2].tolist() for v in parts.values()])], names=names)

    def merge(table):
        wide = lambda c: np.array(table.column(c).to_pylist())
        n, m, v = _merged(wide("n").astype(float), wide("means"), wide("cov"))
        return pa.table([*[table.column(c)[:1] for c in names[:k + 1]], pa.array([n], pa.int64()), pa.array([m.tolist()]), pa.array([v.tolist()])], names=names)

    cells = [f"_k{i}" for i in range(k)]
    out = rows.mapInArrow(sums, schema).groupBy(*cells, "_part").applyInArrow(merge, schema).groupBy(*cells).applyInArrow(merge, schema)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keys)], "n", "means", "cov")


def solve_cell(n: float, means: np.ndarray, cov: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise squared error plus alpha times the squared weights; the intercept is free.

    Without a penalty, dependent features share the weight (the shortest solution).
    """
    p = len(means) - 1
    m = cov.reshape(p + 1, p + 1) * n
    scale = np.sqrt(np.where(np.diag(m)[:p] > 0, np.diag(m)[:p], 1.0))
    a, c = m[:p, :p] + alpha * np.eye(p), m[:p, p]
    scaled = a / np.outer(scale, scale)
    if np.linalg.cond(scaled) < 1e12:
        w = np.linalg.solve(scaled, c / scale) / scale
    else:
        w = np.linalg.lstsq(a, c, rcond=1e-12)[0]
    return float(means[p] - w @ means[:p]), w


def solve(cells: DataFrame, alphas: list[float], keys: tuple = ()) -> DataFrame:
    """keys, alpha, n, intercept and weights of each row of ``cross_products`` and each penalty."""
    kinds = [f"`{k}` {cells.schema[k].dataType.simpleString()}" for k in keys]

    def run(batches):
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                for a in alphas:
                    shift, w = solve_cell(r.n, np.array(r.means), np.array(r.cov), a)
                    out.append((*[getattr(r, k) for k in keys], a, r.n, shift, w.tolist()))
            yield pd.DataFrame(out, columns=[*keys, "alpha", "n", "intercept", "weights"])

    return cells.mapInPandas(run, ", ".join([*kinds, "alpha double, n bigint, intercept double, weights array<double>"]))


def predicted(features: list[str], alias: str = "prediction"):
    """Prediction of a row that has its features beside ``intercept`` and ``weights``."""
    out = F.col("intercept")
    for i, f in enumerate(features):
        out = out + F.get("weights", F.lit(i)) * F.col(f).cast("double")
    return out.alias(alias)


def _long(df: DataFrame, features: list[str], targets: list[str]) -> DataFrame:
    """A row for each target that is there: GW, features, target, y."""
    ys = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in targets])
    return df.select("GW", *features, F.explode(ys).alias("_t")).select("GW", *features, "_t.target", "_t.y").dropna(subset=[*features, "y"])


def linear_cells(df: DataFrame, features: list[str], targets: list[str], cutoffs: list[int], alphas: list[float]) -> DataFrame:
    """target, cutoff, alpha, n, intercept, weights of models trained on GW <= cutoff, for all cells in one scan."""
    rows = _long(df, features, targets).withColumn("cutoff", F.explode(F.array(*map(F.lit, cutoffs)))).where(F.col("GW") <= F.col("cutoff"))
    return solve(cross_products(rows, features, "y", ("target", "cutoff")), alphas, ("target", "cutoff"))


def linear_backtest(df: DataFrame, features: list[str], targets: list[str], cutoffs: list[int], windows: list[int], alphas: list[float]) -> DataFrame:
    """Rolling-origin back-test of linear (alpha 0) and ridge models: metrics of each target, cutoff, window and alpha.

    Trains on GW <= cutoff, tests on the next ``window`` periods; rows with a missing feature or target count nowhere,
    cells without train or test rows are left out.
    """
    models = linear_cells(df, features, targets, cutoffs, alphas)  # a row for each cell of the grid
    grid = F.array(*[F.struct(F.lit(c).alias("cutoff"), F.lit(w).alias("window")) for c, w in product(cutoffs, windows)])
    test = _long(df, features, targets).withColumn("_g", F.explode(grid)).select("*", "_g.cutoff", "_g.window").drop("_g").where(
        (F.col("GW") > F.col("cutoff")) & (F.col("GW") <= F.col("cutoff") + F.col("window")))
    scored = test.join(F.broadcast(models), ["target", "cutoff"])
    keys = ("target", "cutoff", "window", "alpha")
    scored = scored.select(*keys, "y", F.col("n").alias("n_train"), predicted(features))
    return error_metrics(scored, "y", "prediction", (*keys, "n_train")).withColumnRenamed("n", "n_test")
