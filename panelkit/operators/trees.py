"""Random forests and boosted trees of MLlib's regressors for grids, grown from files of binned rows.

MLlib goes through the rows of one fit in its own jobs, a row, tree and feature at a time. Here the rows of all fits are binned once,
a byte for a feature, and lie in the shared folder; a job adds the histograms of one level for all boosted fits, or for many
trees of a forest, chunk by chunk in arrays. Thresholds, bags, sums, gains and predictions are MLlib's, in its order: bags come from its
generator with the seeds that it gives to the tasks, so where a task has no more than ``CHUNK`` rows the sums agree to the last bit.

Files that change are written over in place, never the ones that the same job reads, so a task that runs again gives the same.
"""

from __future__ import annotations

import os
import pickle
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.shared import discard_folder, in_threads, shared_dir

CHUNK = 1 << 16          # rows that are handled at once
HISTOGRAM_BYTES = 32e6   # of the trees that one task grows side by side
GROUP_BYTES = 5e8        # node ids of the trees of a forest that grow side by side
ALONE = 1_000_000        # fits of no more rows are grown by one task, or a forest's trees by some
EPSILON = 2.0 ** -52     # MLlib's: a child with less impurity is a leaf


def handles(estimator) -> bool:
    """Whether fits of this estimator are grown here; others are left to MLlib."""
    if type(estimator) not in (RandomForestRegressor, GBTRegressor):
        return False
    get = estimator.getOrDefault
    forest = type(estimator) is RandomForestRegressor
    return (get("featureSubsetStrategy") == "all" and get("subsamplingRate") == 1.0 and get("minWeightFractionPerNode") == 0.0
            and get("maxBins") <= 256 and 1 <= get("maxDepth") <= 14 and get("impurity") == "variance" and get("minInfoGain") >= 0.0
            and not (estimator.hasParam("weightCol") and estimator.isDefined("weightCol"))
            and (get("bootstrap") and get("numTrees") > 1 if forest else get("lossType") == "squared" and not estimator.isDefined("validationIndicatorCol")))


def _folder(spark: SparkSession) -> str | None:
    """A new folder for this grid that tasks open as files, if the shared folder is one."""
    top = shared_dir(spark)
    path = top.removeprefix("file://") if top.startswith("file://") else top.removeprefix("file:")
    return None if ":" in path.split("/")[0] or not path.startswith("/") else f"{path}/trees-{uuid.uuid4().hex}"


def _numeric(matrix: DataFrame) -> bool:
    """MLlib splits nominal features in another way."""
    kinds = (matrix.schema["features"].metadata or {}).get("ml_attr", {}).get("attrs", {})
    return set(kinds) <= {"numeric"}


# --- thresholds and bags as MLlib draws them
def thresholds_of(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Thresholds of one feature from sampled ``values``; zeros are not counted but make up what is missing of the ``expected`` number."""
    v = values[values != 0.0]
    if not len(v):
        return np.empty(0)
    x, n = np.unique(v, return_counts=True)
    n = n.astype(np.float64)
    zeros = expected - n.sum()
    if zeros > EPSILON * len(v) * 100:
        at = int(np.searchsorted(x, 0.0))
        x, n = np.insert(x, at, 0.0), np.insert(n, at, zeros)
    middle = (x[:-1] + x[1:]) / 2.0
    if len(middle) < bins:
        return middle
    stride = expected / bins
    out, upto, target = [], n[0], stride
    for i in range(1, len(x)):
        before, upto = upto, upto + n[i]
        if abs(before - target) < abs(upto - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def _thresholds(rows: DataFrame, n: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of all features from MLlib's sample: the same rows of each task, about max(bins^2, 10,000) in all."""
    spark = rows.sparkSession
    bins = min(max_bins, n)
    wanted = max(bins * bins, 10000)
    share = wanted / n if wanted < n else 1.0
    x = rows.select(vector_to_array("features").alias("x"))
    if share < 1.0:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        x = DataFrame(spark._jsparkSession.createDataFrame(x._jdf.toJavaRDD().sample(False, share, draw), x._jdf.schema()), spark)
    found = x.toArrow().column("x").combine_chunks()
    flat = found.flatten().to_numpy().reshape(len(found), -1) if len(found) else np.empty((0, 0))
    return [thresholds_of(flat[:, f], share * n, bins) for f in range(flat.shape[1])]


PACKED = 8  # draws in a value


def _bag_column(spark: SparkSession, seed: int) -> Column:
    """Draws of MLlib's Poisson generator with a seed, for a table of one task: eight in a value, the first in its lowest byte."""
    jvm = spark._jvm
    draws = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    draws.reseedRandomGenerator(seed)
    expressions, types = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.types
    none = getattr(getattr(jvm.scala.collection.immutable, "Nil$"), "MODULE$")
    held = expressions.Literal(draws, types.ObjectType(draws.getClass()))
    call = expressions.objects.Invoke(held, "sample", getattr(getattr(types, "IntegerType$"), "MODULE$"), none, none, True, False, False)
    one = Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(call)).cast("bigint")
    out = one
    for i in range(1, PACKED):  # evaluated from left to right, by one generator
        out = out.bitwiseOR(F.shiftleft(one, 8 * i))
    return out


class Bag(NamedTuple):
    """How often a tree takes a row: for each chunk of a task's rows the counts tree by tree."""

    path: str
    trees: int


def draw_bag(spark: SparkSession, path: str, parts: dict[int, int], trees: int, seed: int) -> Bag:
    """Files with the counts for each task's rows; MLlib draws row by row, for all trees of a row, from seed + task + 1."""
    def one(part, n):
        def write(batches):
            held, size, own = [], 0, f"{path}-{part}.{TaskContext.get().taskAttemptId()}"
            with open(own, "wb") as file:
                for batch in batches:
                    held.append(batch.column(0).to_numpy().view(np.uint8))
                    size += len(held[-1])
                    if size >= CHUNK * trees:
                        flat = np.concatenate(held)
                        np.ascontiguousarray(flat[:CHUNK * trees].reshape(-1, trees).T).tofile(file)
                        held, size = [flat[CHUNK * trees:]], size - CHUNK * trees
                rest = n % CHUNK * trees  # the last value may hold draws beyond the last row
                if rest:
                    np.ascontiguousarray(np.concatenate(held)[:rest].reshape(-1, trees).T).tofile(file)
            os.replace(own, f"{path}-{part}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

        values = spark.range(0, -(-n * trees // PACKED), 1, 1).select(_bag_column(spark, seed + part + 1).alias("draws"))
        return values.mapInArrow(write, "n bigint")

    jobs = [one(part, n) for part, n in parts.items()]
    in_threads(spark, lambda job: job.collect(), jobs, spark.sparkContext.defaultParallelism)
    return Bag(path, trees)


# --- rows in files
class Binned(NamedTuple):
    """The rows of one fit, by task of the matrix: chunks of bins, feature by feature, and labels. ``state`` is where a fit keeps what changes."""

    path: str
    parts: dict[int, int]
    thresholds: list[np.ndarray]
    state: str = ""

    @property
    def bins(self) -> list[int]:
        return [len(t) + 1 for t in self.thresholds]


class Rows(NamedTuple):
    """The rows of a fit: those with the target up to a period."""

    target: str
    cutoff: int
    n: int
    max_bins: int
    seed: int


def to_bins(x: np.ndarray, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bin k holds what is at most threshold k: one row of bytes for each column of ``x``."""
    out = np.empty((len(thresholds), len(x)), np.uint8)
    for f, t in enumerate(thresholds):
        out[f] = np.searchsorted(t, x[:, f])
    return out


def write_rows(matrix: DataFrame, wanted: list[Rows], thresholds: list[list[np.ndarray]], folder: str) -> list[Binned | None]:
    """Bin the rows of all fits in one scan; None where a label or feature is NaN or infinite, which MLlib refuses."""
    targets = sorted({r.target for r in wanted})

    def write(batches):
        part, own = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        held = [([], []) for _ in wanted]
        size, total, fine = [0] * len(wanted), [0] * len(wanted), [True] * len(wanted)

        def flush(i, all_of_it):
            bins, y = np.concatenate(held[i][0], axis=1), np.concatenate(held[i][1])
            at = 0
            with open(f"{folder}/{i}-{part}.bins.{own}", "ab") as b, open(f"{folder}/{i}-{part}.y.{own}", "ab") as v:
                while len(y) - at >= CHUNK or all_of_it and at < len(y):
                    np.ascontiguousarray(bins[:, at:at + CHUNK]).tofile(b)
                    y[at:at + CHUNK].tofile(v)
                    at += len(y[at:at + CHUNK])
            held[i], size[i] = ([bins[:, at:]], [y[at:]]), len(y) - at

        for batch in batches:
            gw = batch.column("GW").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            right = np.isfinite(x).all(axis=1)
            labels = {t: (batch.column(t).to_numpy(zero_copy_only=False), batch.column(t).is_valid().to_numpy(zero_copy_only=False)) for t in targets}
            for i, r in enumerate(wanted):
                y, there = labels[r.target]
                take = np.flatnonzero(there & (gw <= r.cutoff))
                if not len(take):
                    continue
                fine[i] = fine[i] and bool(right[take].all() and np.isfinite(y[take]).all())
                held[i][0].append(to_bins(x[take], thresholds[i]))
                held[i][1].append(y[take].astype(np.float64))
                size[i] += len(take)
                total[i] += len(take)
                if size[i] >= CHUNK:
                    flush(i, False)
        for i in range(len(wanted)):
            if size[i]:
                flush(i, True)
            if total[i]:
                for kind in ("bins", "y"):
                    os.replace(f"{folder}/{i}-{part}.{kind}.{own}", f"{folder}/{i}-{part}.{kind}")
        yield pa.RecordBatch.from_pydict({"i": list(range(len(wanted))), "part": [part] * len(wanted), "n": total, "fine": fine}, schema=pa.schema(
            [("i", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("fine", pa.bool_())]))

    os.makedirs(folder, exist_ok=True)
    rows = matrix.select("GW", *targets, vector_to_array("features").alias("x"))
    found = sorted(rows.mapInArrow(write, "i int, part int, n bigint, fine boolean").collect())
    return [Binned(f"{folder}/{i}", {f["part"]: f["n"] for f in found if f["i"] == i and f["n"]}, thresholds[i])
            if all(f["fine"] for f in found if f["i"] == i) else None for i in range(len(wanted))]


class File:
    """Arrays at places of a file that is written over in place."""

    def __init__(self, path: str):
        self.handle = os.open(path, os.O_RDWR | os.O_CREAT, 0o666)

    def get(self, dtype, count: int, at: int) -> np.ndarray:
        size = np.dtype(dtype).itemsize
        found = os.pread(self.handle, count * size, at * size)
        if len(found) != count * size:
            raise EOFError(f"{len(found)} of {count * size} bytes")
        return np.frombuffer(found, dtype)

    def put(self, values: np.ndarray, at: int) -> None:
        os.pwrite(self.handle, np.ascontiguousarray(values), at * values.itemsize)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        os.close(self.handle)


# --- trees
class Table(NamedTuple):
    """A tree as arrays over node ids; children are neighbours, a leaf leads to itself."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    value: np.ndarray
    levels: int

    def down(self, node: np.ndarray, bins: np.ndarray, column: np.ndarray) -> np.ndarray:
        """One step from each row's node; ``column`` counts the rows."""
        at = (self.feature * bins.shape[1]).take(node)
        at += column
        return self.left.take(node) + (bins.ravel().take(at) > self.split.take(node))


class Tree:
    """A tree that grows by a level at a time."""

    def __init__(self, depth: int):
        self.depth, self.level = depth, 0
        self.feature, self.split, self.left, self.value = [0], [255], [0], [0.0]
        self.active, self.stats = [0], None  # nodes of this level that may split; their counts, sums and sums of squares
        self.ids = np.uint8 if 2 ** (depth + 1) <= 256 else np.uint16

    def table(self) -> Table:
        return Table(np.array(self.feature, np.intp), np.array(self.split, np.uint8), np.array(self.left, self.ids), np.array(self.value), self.level)

    def places(self, width: int) -> np.ndarray:
        """Where the histogram of a node begins; rows of settled nodes go behind all others."""
        out = np.full(len(self.left), len(self.active) * width, np.intp)
        out[self.active] = np.arange(len(self.active)) * width
        return out

    def grow(self, gain, feature, split, parent, left, right) -> None:
        if self.level == 0:
            self.value[0] = _mean(parent[:, 0])
        self.level += 1
        active, stats = [], []
        for i, node in enumerate(self.active):
            if not gain[i] > 0:
                continue
            self.feature[node], self.split[node], self.left[node] = int(feature[i]), int(split[i]), len(self.left)
            for side in (left[:, i], right[:, i]):
                if self.level < self.depth and not abs(float(_impurity(*side))) < EPSILON:
                    active.append(len(self.left))
                    stats.append(side)
                self.feature.append(0)
                self.split.append(255)
                self.left.append(len(self.left))
                self.value.append(_mean(side))
        self.active, self.stats = active, np.array(stats).T if stats else None


def _mean(stats) -> float:
    return float(stats[1] / stats[0]) if stats[0] else 0.0


def _impurity(n, s, q):
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n == 0, 0.0, (q - s * s / n) / n)


def best_splits(h: np.ndarray, bins: list[int], stats: np.ndarray | None, least: int, least_gain: float) -> tuple:
    """The best split of each node: gains, features, bins; counts, sums and sums of squares of the nodes and both children.

    ``h`` has them by feature, statistic, node and bin; ``stats`` those of the nodes as their parents' splits gave them.
    The first of equal gains wins, and splits that are not allowed have minus infinity.
    """
    best, parent = None, stats
    each = np.arange(h.shape[2])
    for f, size in enumerate(bins):
        if size < 2:
            continue
        upto = np.cumsum(h[f, :, :, :size], axis=-1)
        left = upto[..., :-1]
        right = upto[..., -1:] - left
        if parent is None:
            parent = left[..., 0] + right[..., 0]
        whole = left[0] + right[0]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = _impurity(*parent)[:, None] - left[0] / whole * _impurity(*left) - right[0] / whole * _impurity(*right)
        gain = np.where((left[0] >= least) & (right[0] >= least) & (gain >= least_gain), gain, -np.inf)
        at = gain.argmax(axis=1)
        top = gain[each, at]
        if best is None:
            best = (top, np.full(len(at), f), at, left[:, each, at], right[:, each, at])
        else:
            better = top > best[0]
            best = tuple(np.where(better, a, b) for a, b in zip((top, f, at, left[:, each, at], right[:, each, at]), best))
    gain, feature, split, left, right = best
    return gain, feature, split, parent, left, right


def add_histograms(h: np.ndarray, bins: np.ndarray, sizes: list[int], place: np.ndarray, weights: list) -> None:
    """Add the rows to ``h`` (feature, statistic, node, bin); ``place`` is where each row's node begins, None is a weight of 1."""
    nodes, width = h.shape[2:]
    at = np.empty(len(place), np.intp)
    for f, size in enumerate(sizes):
        if size < 2:
            continue
        np.add(place, bins[f], out=at)
        for j, w in enumerate(weights):
            h[f, j] += np.bincount(at, w, (nodes + 1) * width)[:nodes * width].reshape(nodes, width)


class Ensemble(NamedTuple):
    """A fitted model. ``weights`` are those of boosted trees, None stands for the mean."""

    trees: list[Table]
    weights: list[float] | None
    thresholds: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins, column = to_bins(x, self.thresholds), np.arange(len(x))
        out = np.zeros(len(x))
        for i, tree in enumerate(self.trees):
            node = np.zeros(len(x), tree.left.dtype)
            for _ in range(tree.levels):
                node = tree.down(node, bins, column)
            out += tree.value.take(node) if self.weights is None else tree.value.take(node) * self.weights[i]
        return out / len(self.trees) if self.weights is None else out

    def transform(self, rows: DataFrame) -> DataFrame:
        """GW, label and prediction of rows with a vector of features."""
        def score(batches):
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                p = self.predict(x) if len(x) else np.empty(0)
                yield pa.RecordBatch.from_arrays([batch.column("GW"), batch.column("label"), pa.array(p)], ["GW", "label", "prediction"])

        gw = rows.schema["GW"].dataType.simpleString()
        return rows.select("GW", F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")).mapInArrow(
            score, f"GW {gw}, label double, prediction double")


# --- forests
def deal(parts: dict[int, int], tasks: int) -> list[list[int]]:
    """The parts in their order, in at most so many lists of about as many rows."""
    if len(parts) <= tasks:
        return [[part] for part in parts]
    share, out, upto = sum(parts.values()) / tasks, [], 0
    for part, n in parts.items():
        if not out or upto + n / 2 > share * len(out):
            out.append([])
        out[-1].append(part)
        upto += n
    return out


def _units(spark: SparkSession, units: list, work, schema: str) -> DataFrame:
    """One task for each unit of work; ``work`` yields record batches."""
    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from work(units[i])

    return spark.range(0, len(units), 1, len(units)).mapInArrow(run, schema)


class Forest(NamedTuple):
    """A forest's rows, bags and limits of a split."""

    rows: Binned
    bag: Bag
    depth: int
    least: int
    least_gain: float


class Level(NamedTuple):
    """What tasks need of a tree for the histograms of one level."""

    table: Table
    places: np.ndarray
    nodes: int
    stats: np.ndarray | None


def _level(tree: Tree, rows: Binned) -> Level:
    return Level(tree.table(), tree.places(max(rows.bins)), len(tree.active), tree.stats)


def _held(rows: Binned, nodes: int) -> int:
    """Trees whose histograms fit side by side."""
    return max(1, int(HISTOGRAM_BYTES // (len(rows.bins) * 3 * max(rows.bins) * 8 * nodes)))


def forest_parts(forest: Forest, parts: list[int], first: int, level: int, trees: dict[int, Level]) -> dict[int, np.ndarray]:
    """Histograms of some trees over some tasks' rows. The trees' places in the bag begin at ``first``."""
    rows, bag = forest.rows, forest.bag
    sizes, width = rows.bins, max(rows.bins)
    count, sums = len(sizes), {}
    for part in parts:
        n, path, state = rows.parts[part], f"{rows.path}-{part}", f"{rows.state}-{part}"
        mine = {i: np.zeros((count, 3, t.nodes, width)) for i, t in trees.items()}
        with File(f"{path}.bins") as b, File(f"{path}.y") as v, File(f"{bag.path}-{part}") as w, \
                File(f"{state}.nodes{(level - 1) % 2}") as old, File(f"{state}.nodes{level % 2}") as new:
            for at in range(0, n, CHUNK):
                m = min(CHUNK, n - at)
                bins, y, column = b.get(np.uint8, count * m, count * at).reshape(count, m), v.get(np.float64, m, at), np.arange(m)
                for i, t in trees.items():
                    if level:
                        ids = t.table.left.dtype
                        node = t.table.down(old.get(ids, m, i * n + at) if level > 1 else np.zeros(m, ids), bins, column)
                        new.put(node, i * n + at)
                        place = t.places.take(node)
                    else:
                        place = np.zeros(m, np.intp)
                    times = w.get(np.uint8, m, at * bag.trees + (first + i) * m).astype(np.float64)
                    weighted = times * y
                    add_histograms(mine[i], bins, sizes, place, [times, weighted, weighted * y])
        for i, h in mine.items():
            sums[i] = np.add(sums[i], h, out=sums[i]) if i in sums else h
    return sums


def grow_alone(forest: Forest, first: int, count: int) -> list[Table]:
    """Some trees of a forest from beginning to end, in one task."""
    forest = forest._replace(rows=forest.rows._replace(state=f"{forest.rows.state}-{first}"))
    trees = [Tree(forest.depth) for _ in range(count)]
    for level in range(forest.depth):
        todo = [i for i, t in enumerate(trees) if t.active]
        step = _held(forest.rows, max([1, *(len(trees[i].active) for i in todo)]))
        for k in range(0, len(todo), step):
            some = {i: _level(trees[i], forest.rows) for i in todo[k:k + step]}
            for i, h in forest_parts(forest, list(forest.rows.parts), first, level, some).items():
                trees[i].grow(*best_splits(h, forest.rows.bins, some[i].stats, forest.least, forest.least_gain))
    return [t.table() for t in trees]


_HIST = pa.schema([("tree", pa.int32()), ("part", pa.int32()), ("h", pa.binary())])


def _forest_level(spark: SparkSession, forest: Forest, first: int, trees: list[Tree], level: int) -> None:
    """Add the histograms of one level of all ``trees`` (the forest's from ``first`` on) in tasks, find the splits in others, and grow."""
    rows, cores = forest.rows, spark.sparkContext.defaultParallelism
    sizes, width = rows.bins, max(rows.bins)
    some = {i: _level(t, rows) for i, t in enumerate(trees) if t.active}
    dealt = deal(rows.parts, cores)
    step = min(_held(rows, max(t.nodes for t in some.values())), -(-len(some) * len(dealt) // cores))
    todo = list(some)
    units = [(parts, todo[k:k + step]) for k in range(0, len(todo), step) for parts in dealt]

    def work(unit):
        parts, mine = unit
        for i, h in forest_parts(forest, parts, first, level, {i: some[i] for i in mine}).items():
            yield pa.RecordBatch.from_pydict({"tree": [i], "part": [parts[0]], "h": [h.tobytes()]}, schema=_HIST)

    def pick(found):
        i, h = found.column("tree")[0].as_py(), None
        for j in np.argsort(found.column("part").to_numpy()).tolist():
            one = np.frombuffer(found.column("h")[j].as_buffer()).reshape(len(sizes), 3, -1, width)
            h = one.copy() if h is None else np.add(h, one, out=h)
        best = best_splits(h, sizes, some[i].stats, forest.least, forest.least_gain)
        return pa.table({"tree": pa.array([i], pa.int32()), "found": pa.array([pickle.dumps(best)], pa.binary())})

    for r in _units(spark, units, work, "tree int, part int, h binary").groupBy("tree").applyInArrow(pick, "tree int, found binary").collect():
        trees[r["tree"]].grow(*pickle.loads(bytes(r["found"])))


def grow_forest(spark: SparkSession, forest: Forest) -> Ensemble:
    """All trees, level by level; node ids of as many trees as ``GROUP_BYTES`` hold are kept at a time."""
    rows, total, out = forest.rows, forest.bag.trees, []
    group = int(max(1, min(total, GROUP_BYTES // sum(rows.parts.values()))))
    for first in range(0, total, group):
        trees = [Tree(forest.depth) for _ in range(min(group, total - first))]
        for level in range(forest.depth):
            if any(t.active for t in trees):
                _forest_level(spark, forest, first, trees, level)
        out += [t.table() for t in trees]
    return Ensemble(out, None, rows.thresholds)


# --- boosting
class Boosting:
    """One boosted fit between its levels."""

    def __init__(self, rows: Binned, estimator):
        get = estimator.getOrDefault
        self.rows, self.depth, self.rounds, self.rate = rows, get("maxDepth"), get("maxIter"), get("stepSize")
        self.least, self.least_gain = get("minInstancesPerNode"), get("minInfoGain")
        self.done, self.tree = [], Tree(self.depth)

    def weight(self, i: int) -> float:
        return self.rate if i else 1.0

    def step(self) -> dict:
        """What tasks need for the next histograms: the tree so far, or the one before it whose values the predictions lack."""
        level = self.tree.level
        table = self.tree.table() if level else self.done[-1] if self.done else None
        return {"rows": self.rows, "round": len(self.done), "level": level, "table": table, "weight": self.weight(len(self.done) - 1),
                "places": self.tree.places(max(self.rows.bins)), "nodes": len(self.tree.active)}

    def take(self, h: np.ndarray) -> bool:
        """Grow by a level; true when all trees are there."""
        h = h.reshape(len(self.rows.bins), 3, -1, max(self.rows.bins))
        self.tree.grow(*best_splits(h, self.rows.bins, self.tree.stats, self.least, self.least_gain))
        if not self.tree.active:
            self.done.append(self.tree.table())
            self.tree = Tree(self.depth)
        return len(self.done) == self.rounds

    def model(self) -> Ensemble:
        return Ensemble(self.done, [self.weight(i) for i in range(self.rounds)], self.rows.thresholds)


def boost_parts(parts: list[int], rows: Binned, round: int, level: int, table: Table | None, weight: float, places: np.ndarray, nodes: int) -> np.ndarray:
    """Histograms of some tasks' rows; at a tree's first level their predictions take in the tree before."""
    sizes, width = rows.bins, max(rows.bins)
    count, first, sums = len(sizes), level == 0, None
    come_from = (table.levels if first and table else level) - 1  # the level whose node ids were written last; at 0 all rows are at the root
    for part in parts:
        n, path, state = rows.parts[part], f"{rows.path}-{part}", f"{rows.state}-{part}"
        h = np.zeros((count, 3, nodes, width))
        with File(f"{path}.bins") as b, File(f"{path}.y") as v, File(f"{state}.nodes{come_from % 2}") as old, File(f"{state}.nodes{level % 2}") as new, \
                File(f"{state}.sum{(round + 1) % 2}") as before, File(f"{state}.sum{round % 2}") as after:
            for at in range(0, n, CHUNK):
                m = min(CHUNK, n - at)
                bins, y = b.get(np.uint8, count * m, count * at).reshape(count, m), v.get(np.float64, m, at)
                place = np.zeros(m, np.intp)
                if table:
                    ids = table.left.dtype
                    node = table.down(old.get(ids, m, at) if come_from > 0 else np.zeros(m, ids), bins, np.arange(m))
                    if not first:
                        new.put(node, at)
                        place = places.take(node)
                if round:
                    if first:
                        total = (before.get(np.float64, m, at) if round > 1 else 0.0) + table.value.take(node) * weight
                        after.put(total, at)
                    else:
                        total = after.get(np.float64, m, at)
                    y = 2.0 * (y - total)
                add_histograms(h, bins, sizes, place, [None, y, y * y])
        sums = h if sums is None else np.add(sums, h, out=sums)
    return sums


def boost_alone(fit: Boosting) -> list[Table]:
    """A whole boosted fit in one task."""
    while not fit.take(boost_parts(list(fit.rows.parts), **fit.step())):
        pass
    return fit.done


_BOOST = pa.schema([("fit", pa.int32()), ("part", pa.int32()), ("h", pa.binary())])


def boost_all(spark: SparkSession, fits: list[Boosting]) -> list[Ensemble]:
    """Grow all fits side by side, one level of each in a job."""
    cores = spark.sparkContext.defaultParallelism
    dealt = [deal(f.rows.parts, cores) for f in fits]
    going = list(range(len(fits)))
    while going:
        steps = {i: fits[i].step() for i in going}
        tasks = max(len(dealt[i]) for i in going)
        at_once = max(1, len(going) * tasks // cores)
        units = [[(i, dealt[i][t]) for i in going[k:k + at_once] if t < len(dealt[i])] for k in range(0, len(going), at_once) for t in range(tasks)]

        def work(unit, steps=steps):
            for i, parts in unit:
                yield pa.RecordBatch.from_pydict({"fit": [i], "part": [parts[0]], "h": [boost_parts(parts, **steps[i]).tobytes()]}, schema=_BOOST)

        found, sums = _units(spark, [u for u in units if u], work, "fit int, part int, h binary").toArrow(), {}
        for i, _, j in sorted(zip(found.column("fit").to_pylist(), found.column("part").to_pylist(), range(len(found)))):
            h = np.frombuffer(found.column("h")[j].as_buffer())
            sums[i] = sums[i] + h if i in sums else h
        going = [i for i in going if not fits[i].take(sums[i])]
    return [f.model() for f in fits]


def all_alone(spark: SparkSession, boosted: dict, forests: dict) -> dict:
    """Fits of few rows: a task grows a boosted fit or some of a forest's trees from beginning to end, as many jobs would take longer."""
    trees = sum(f.bag.trees for f in forests.values())
    step = -(-trees // (3 * spark.sparkContext.defaultParallelism)) if trees else 1
    units = [(k, f, 0, 0) for k, f in boosted.items()] + [
        (k, f, at, min(step, f.bag.trees - at)) for k, f in forests.items() for at in range(0, f.bag.trees, step)]

    def work(unit):
        _, fit, first, count = unit
        done = boost_alone(fit) if isinstance(fit, Boosting) else grow_alone(fit, first, count)
        yield pa.RecordBatch.from_pydict({"trees": [pickle.dumps(done)]}, schema=pa.schema([("trees", pa.binary())]))

    # a task's unit is known by its place, as rows come back in the order of tasks
    grown = {}
    if units:
        for (k, *_), r in zip(units, _units(spark, units, work, "trees binary").collect(), strict=True):
            grown.setdefault(k, []).extend(pickle.loads(bytes(r["trees"])))
    weights = {k: [f.weight(i) for i in range(f.rounds)] for k, f in boosted.items()}
    return {k: Ensemble(t, weights.get(k), (boosted.get(k) or forests[k]).rows.thresholds) for k, t in grown.items()}


# --- all of a grid
def train(matrix: DataFrame, fits: dict, at_once: int = 3) -> dict:
    """Models (or what went wrong) by the keys of ``fits``: key -> (estimator, target, cutoff, rows of the fit).

    Fits that MLlib has to do are not among them: other estimators, nominal, NaN and infinite features or labels, features that are all constant, and
    a shared folder that cannot be opened as files.
    """
    spark = matrix.sparkSession
    folder = _folder(spark)
    fits = {k: v for k, v in fits.items() if handles(v[0])}
    if not fits or folder is None or not _numeric(matrix):
        return {}
    rows_of = {k: Rows(target, cutoff, n, e.getOrDefault("maxBins"), e.getOrDefault("seed")) for k, (e, target, cutoff, n) in fits.items()}
    wanted = sorted(set(rows_of.values()))
    out = {}
    try:
        thresholds = in_threads(spark, lambda r: _thresholds(matrix.where(F.col(r.target).isNotNull() & (F.col("GW") <= r.cutoff)), r.n, r.max_bins, r.seed), wanted, 12)
        keep = [i for i, t in enumerate(thresholds) if sum(map(len, t))]
        found = write_rows(matrix, [wanted[i] for i in keep], [thresholds[i] for i in keep], folder) if keep else []
        binned = {wanted[i]: b for i, b in zip(keep, found) if b}
        mine = {k: v for k, v in fits.items() if rows_of[k] in binned}

        def own(k) -> Binned:
            """The fit's rows, with a folder of its own for the files that change."""
            os.makedirs(at := f"{folder}/fit-{list(fits).index(k)}")
            return binned[rows_of[k]]._replace(state=f"{at}/s")

        few = {k for k in mine if fits[k][3] <= ALONE}
        boosted = {k: Boosting(own(k), fits[k][0]) for k in mine if isinstance(fits[k][0], GBTRegressor)}
        bags = {}  # tasks with as many rows have the same bag
        for k in mine:
            e = fits[k][0]
            if k not in boosted:
                bags.setdefault((tuple(binned[rows_of[k]].parts.items()), e.getOrDefault("numTrees"), e.getOrDefault("seed")), []).append(k)

        def guarded(keys, work):
            try:
                out.update(work())
            except Exception as e:
                out.update({k: e for k in keys})

        def drawn(key) -> dict:
            parts, trees, seed = key
            os.makedirs(at := f"{folder}/bag-{list(bags).index(key)}")
            bag = draw_bag(spark, f"{at}/n", dict(parts), trees, seed)
            get = {k: fits[k][0].getOrDefault for k in bags[key]}
            return {k: Forest(own(k), bag, g("maxDepth"), g("minInstancesPerNode"), g("minInfoGain")) for k, g in get.items()}

        def forests(key):
            found = drawn(key)
            for k in bags[key]:
                guarded([k], lambda k=k: {k: grow_forest(spark, found[k])})
                discard_folder(spark, os.path.dirname(found[k].rows.state))
            discard_folder(spark, os.path.dirname(found[k].bag.path))
            return {}

        def alone():
            found = {k: f for key in bags if few.issuperset(bags[key]) for k, f in drawn(key).items()}
            return all_alone(spark, {k: f for k, f in boosted.items() if k in few}, found)

        many = [k for k in boosted if k not in few]
        todo = [lambda: guarded(few, alone)] * bool(few)
        todo += [lambda: guarded(many, lambda: dict(zip(many, boost_all(spark, [boosted[k] for k in many]))))] * bool(many)
        todo += [lambda key=key: guarded(bags[key], lambda: forests(key)) for key in bags if not few.issuperset(bags[key])]
        in_threads(spark, lambda work: work(), todo, at_once)
        return out
    finally:
        discard_folder(spark, folder)
