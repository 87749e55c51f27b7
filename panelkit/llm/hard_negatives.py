"""Hard-negative mining by a secondary sort.

Scores of (anchor, row) pairs are dealt out by anchor and sorted by (anchor, descending score, id) within each task. An
iterator reads that stream once: a positive opens a window of scores, and the negatives that follow are emitted into the
open windows until each is full. It holds the open windows and the first negatives of the score just read, no anchor's
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.shared import saved

POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least so many hundredths of the positive's, and at most the positive's.
LOW = 80
SCALE = 256
#: Anchors held at once against all rows; 20,000 of 64 components are 10 MB.
ANCHORS_PER_BLOCK = 20_000
#: Scores that a worker computes at once.
SCORES_AT_ONCE = 2_000_000
_LEAST, _MOST = -(2**63) + 1, 2**63 - 1


class _Best:
    """The first ``k`` (score descending, id) of each slot."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score, self.id = np.full((slots, k), _LEAST, np.int64), np.full((slots, k), _MOST, np.int64)
        self.row = np.full((slots, k), -1, np.int64)

    def offer(self, slot, score, ids, row) -> None:
        last, last_id = self.score[slot, -1], self.id[slot, -1]
        better = (self.row[slot, -1] < 0) | (score > last) | ((score == last) & (ids < last_id))
        slot, score, ids, row = slot[better], score[better], ids[better], row[better]
        if not len(slot):
            return
        touched = np.unique(slot)
        held = self.row[touched] >= 0
        slot = np.concatenate([np.repeat(touched, self.k)[held.ravel()], slot])
        score = np.concatenate([self.score[touched][held], score])
        ids = np.concatenate([self.id[touched][held], ids])
        row = np.concatenate([self.row[touched][held], row])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids, row = slot[order], score[order], ids[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        slot, place = slot[keep], place[keep]
        self.score[slot, place], self.id[slot, place], self.row[slot, place] = score[keep], ids[keep], row[keep]


def _matrix(vectors, scale: float, width: int = 0):
    """Whole components floor(scale * x), shorter vectors filled up with 0: doubles where products stay exact, else objects."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(np.clip(np.asarray(vectors.flatten(), np.float64), -1e300, 1e300) * scale)
    width = max(width, int(sizes.max()) if len(sizes) else 0)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes]) if len(sizes) else np.zeros(0, int)] = values
    return out


def _products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond the range of a long they stay at its ends."""
    width = min(rows.shape[1], anchors.shape[1])  # components that one side lacks count 0
    rows, anchors = rows[:, :width], anchors[:, :width]
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    if width * np.abs(rows).max() * np.abs(anchors).max() < 2.0**53:
        return rows @ anchors.T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(rows) @ whole(anchors).T, _LEAST, _MOST).astype(np.int64)


class _Anchors:
    """A block of anchors, and the scores of their positives once they are known."""

    def __init__(self, rows: list, first: int, scale: float):
        self.first = first
        self.id = np.array([r["id"] for r in rows], np.int64)
        codes: dict = {}
        self.label = np.array([codes.setdefault(r["label"], len(codes)) for r in rows], np.int64)
        self.codes = codes
        self.vector = _matrix(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), scale)
        self.low = self.high = None

    def chunks(self, batches, scale: float):
        """(ids, label codes, matrix, row number of the first) of the rows, in pieces; the first is short, so that bounds are known early."""
        size, done = 64, 0
        most = max(1, SCORES_AT_ONCE // max(1, len(self.id)))
        for b in batches:
            ids, x = b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(2), scale)
            label = np.array([self.codes.get(v, -1) for v in b.column(1).to_pylist()], np.int64)
            at = 0
            while at < len(ids):
                end = at + min(size, most)
                yield ids[at:end], label[at:end], x[at:end], done + at
                at, size = end, most
            done += len(ids)


_PAIRS = "anchor bigint, anchor_id bigint, score bigint, id bigint, positive boolean"


def _batch(block, slot_anchor, best: _Best, positive: bool, once: bool):
    slot, place = np.nonzero(best.row >= 0)
    a, row = slot_anchor[slot], best.row[slot, place]
    score, ids = best.score[slot, place], best.id[slot, place]
    if once:  # a row that several windows hold goes once
        keep = np.unique(np.stack([a, row]), axis=1, return_index=True)[1]
        a, score, ids = a[keep], score[keep], ids[keep]
    for i in range(0, len(a), 50_000):
        p = slice(i, i + 50_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[p] + block.first), pa.array(block.id[a[p]]), pa.array(score[p]), pa.array(ids[p]), pa.array(np.full(len(a[p]), positive))],
            names=["anchor", "anchor_id", "score", "id", "positive"])


def _near(block, k: int, scale: float):
    """For each anchor of the block the task's first ``k`` other rows of its label."""
    def run(batches):
        shared, best = block.value, _Best(len(block.value.id), k)
        of = {c: np.flatnonzero(shared.label == c) for c in range(len(shared.codes))}
        for ids, label, x, first in shared.chunks(batches, scale):
            for c in np.unique(label[label >= 0]).tolist():
                at, a = np.flatnonzero(label == c), of[c]
                s = _products(x[at], shared.vector[a])
                r, j = np.nonzero((s >= best.score[a, -1]) & (ids[at][:, None] != shared.id[a]))
                best.offer(a[j], s[r, j].astype(np.int64), ids[at[r]], first + at[r])
        yield from _batch(shared, np.arange(len(shared.id)), best, True, False)

    return run


def _hard(block, k: int, scale: float):
    """For each window of the block's anchors the task's first ``k`` rows of other labels in it."""
    def run(batches):
        shared = block.value
        n, width = shared.low.shape
        best = _Best(n * width, k)
        for ids, label, x, first in shared.chunks(batches, scale):
            s = _products(x, shared.vector)
            other = label[:, None] != shared.label
            for w in range(width):
                slots = np.arange(n) * width + w
                r, j = np.nonzero(other & (s <= shared.high[:, w]) & (s >= np.maximum(shared.low[:, w], best.score[slots, -1])))
                best.offer(slots[j], s[r, j].astype(np.int64), ids[r], first + r)
        yield from _batch(shared, np.repeat(np.arange(n), width), best, False, True)

    return run


def _windows(low: int, positives: int, negatives: int):
    """The iterator over pairs sorted by (anchor, descending score, id)."""
    def run(batches):
        anchor = at_score = None
        open_, tied = [], []
        for b in batches:
            out = []

            def emit(w, anchor_id, neg, score):
                w[2] += 1
                out.append((anchor_id, w[0], w[2], neg, w[1], score))

            for a, anchor_id, score, i, positive in zip(*[c.to_pylist() for c in b.columns]):
                if a != anchor:
                    anchor, at_score, open_, tied, n_open = a, None, [], [], 0
                if score != at_score:
                    at_score, tied = score, []
                    # windows that are full or lie above all that follows
                    open_ = [w for w in open_ if w[2] < negatives and low * w[1] <= 100 * score]
                if positive:
                    if n_open < positives:
                        n_open += 1
                        if low * score <= 100 * score:
                            open_.append(w := [i, score, 0])
                            for neg in tied:  # of the same score, with smaller ids
                                emit(w, anchor_id, neg, score)
                    continue
                for w in open_:
                    if w[2] < negatives:
                        emit(w, anchor_id, i, score)
                if len(tied) < negatives:
                    tied.append(i)
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   scale: float = SCALE, anchors_per_block: int = ANCHORS_PER_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of bigint ``id``, ``label`` and array ``vector``.

    A score is the inner product of floor(scale * x), higher first, ties by smaller id. Rows for which ``anchor`` holds are
    the stated query set: they are held in blocks of about ``anchors_per_block`` against all rows. An anchor's positives are
    its first ``positives`` other rows of the same label; for each, the first ``negatives`` rows of other labels whose score
    lies between ``low`` hundredths of the positive's score and that score are returned.

    Two passes over the rows, as windows are known only with the positives. In each a task sends on only the pairs
    that may be among the first of their anchor or window, so the shuffle holds at most positives * negatives rows of an
    anchor and task, and no result is lost. An anchor's pairs meet in one task, as a sorted stream.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Shorter vectors are filled up
    with 0, products beyond the range of a long stay at its ends. Repeated rows are rows of their own, but a row is never a
    positive of an anchor of its id, and equal anchors are one. Other columns are ignored; empty tables, anchors without
    positives and windows without negatives give no rows.
    """
    spark = vectors.sparkSession
    ok = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("id").cast("bigint").alias("id"), "label", F.col("vector").cast("array<double>").alias("vector"), anchor.alias("anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ok)
    chosen = saved(rows.where("anchor").select("id", "label", "vector").distinct(), "anchors")
    n = chosen.count()
    parts = max(1, -(-n // anchors_per_block))
    rows, first, pairs = rows.select("id", "label", "vector"), 0, None
    for part in range(parts if n else 0):
        # about anchors_per_block rows
        block = _Anchors(chosen.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(parts)) == part).collect(), first, scale)
        shared = spark.sparkContext.broadcast(block)
        near = rows.mapInArrow(_near(shared, positives, scale), _PAIRS)
        order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
        near = saved(near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= positives), "positives")
        block.low, block.high = (np.full((len(block.id), positives), v, np.int64) for v in (_MOST, _LEAST))
        for r in near.select("anchor", "r", "score").collect():  # at most ``positives`` for each anchor of the block
            block.low[r["anchor"] - first, r["r"] - 1] = -(-low * r["score"] // 100)
            block.high[r["anchor"] - first, r["r"] - 1] = r["score"]
        hard = rows.mapInArrow(_hard(spark.sparkContext.broadcast(block), negatives, scale), _PAIRS)
        both = near.drop("r").unionByName(hard)
        pairs = both if pairs is None else pairs.unionByName(both)
        first += len(block.id)
    pairs = spark.createDataFrame([], _PAIRS) if pairs is None else pairs
    # the secondary sort: repartitionAndSortWithinPartitions with (anchor, descending score, id) as key, in the JVM
    stream = pairs.repartition("anchor").sortWithinPartitions("anchor", F.col("score").desc(), "id")
    return stream.mapInArrow(_windows(low, positives, negatives),
                             "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings whose vec_id is divisible by 100; the label of ids divisible by 7 moves on by one of ten."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = e.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)
