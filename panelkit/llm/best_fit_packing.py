"""Best-fit packing of documents into sequences by a linear grouping scheme.

Lengths are at most the capacity, so everything that is planned is planned on their histogram: large lengths are
grouped by equal cardinality and rounded up to the group's largest, the few sizes that are left are packed by
configurations (a linear program solved by column generation), actual documents take the places of the rounded ones,
and what remains goes best-fit into the gaps, longest first. The plan is a table of rank intervals for each length; its size depends on
the capacity, not on the number of documents. Documents find their place by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import tokens
from panelkit.shared import saved

CAPACITY, END_ID = 2048, 0
GROUPS = 64             # sizes that large lengths are rounded to, at most
TOLERANCE = 1e-3        # of the linear program
OPEN_PLACES = (2, 1, 0)  # numbers of open places that are tried for each configuration
SMALL = 8               # lengths up to capacity / SMALL are small
RANKED = 50_000         # rows of one length that one task ranks, on average


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece; longer documents are cut, the first piece may be shorter."""
    extra = ", ids array<int>" if keep_ids else ""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint{extra}"

    def run(batches):
        for b in batches:
            at, rows, cut = [], [], []
            for i, text in enumerate(b.column("text")):
                ids = tokens.ids_of(path, text.as_py(), end_id)
                first = len(ids) % capacity or capacity
                bounds = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
                for k, (s, e) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[s:e]
                    at.append(i)
                    rows.append((k, s, e - s, zlib.crc32(part.astype("<u4").tobytes())))
                    if keep_ids:
                        cut.append(part.astype(np.int32))
            cols = list(zip(*rows)) or [(), (), (), ()]
            arrays = [b.column("doc_id").take(pa.array(at, pa.int32())), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                arrays.append(pa.array(cut, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations (number of each size) and how often to use them, from the linear program's optimum."""
    k = len(sizes)
    r, b = np.array(sizes), np.array(demand, float)
    basis = np.diag((capacity // r).astype(float))
    for _ in range(50 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(1, capacity + 1):  # unbounded knapsack: most valuable configuration
            best[c], fits = best[c - 1], np.flatnonzero(r <= c)
            if len(fits):
                value = best[c - r[fits]] + price[fits]
                if value.max() > best[c] + 1e-12:
                    best[c], last[c] = value.max(), fits[value.argmax()]
        if best[capacity] <= 1 + TOLERANCE:  # within this share of the optimum
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                column[last[c]] += 1
                c -= r[last[c]]
        now, step = np.linalg.solve(basis, b), np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, now / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, ratio.argmin()] = column
    return [(basis[:, i].astype(int), max(0.0, x)) for i, x in enumerate(np.linalg.solve(basis, b))]


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS, small: int = SMALL):
    """(intervals, number of sequences) for ``counts`` documents of each length.

    An interval (length, rank, n, sequence, per, offset) says: the n documents of the length from that rank on go to
    consecutive sequences from ``sequence`` on, ``per`` of them to each, from ``offset`` on.
    """
    queues: dict[int, list[list[int]]] = {}  # rounded size -> [length, documents], longest first
    large = [(s, counts[s]) for s in sorted(counts, reverse=True) if counts[s] and capacity > s and s * small > capacity]
    each, size, room = -(-sum(c for _, c in large) // groups), 0, 0
    for s, c in large:
        while c:
            if not room:
                size, room = s, each
                queues.setdefault(size, [])
            n = min(c, room)
            queues[size].append([s, n])
            c, room = c - n, room - n
    sizes = list(queues)
    chosen = configurations(sizes, [sum(n for _, n in queues[s]) for s in sizes], capacity) if sizes else []
    # with the smallest places of each configuration open, best fit finds longer documents for the room that rounding
    # has left over; where little is rounded the whole configuration is better
    tried = (_laid_out(counts, capacity, {s: [list(q) for q in queues[s]] for s in sizes}, chosen, n) for n in OPEN_PLACES)
    return min(tried, key=lambda x: x[1])


def _laid_out(counts, capacity, queues, chosen, open_places):
    """The plan that keeps so many of the smallest places of each chosen configuration open for best fit."""
    used: dict[int, int] = defaultdict(int)
    intervals: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> runs (first sequence, how many)
    opened = 0

    def put(length: int, n: int, sequence: int, per: int, offset: int) -> None:
        intervals.append((length, used[length], n, sequence, per, offset))
        used[length] += n

    left = {s: c for s, c in counts.items() if c and s < capacity}
    if counts.get(capacity):
        put(capacity, counts[capacity], 0, 1, 0)
        opened = counts[capacity]

    sizes = list(queues)
    for column, times in chosen:
        places = [s for s, a in zip(sizes, column) for _ in range(a)]
        bins, slots = int(times + 1e-9), places[:max(0, len(places) - open_places)]
        bins = bins if slots else 0
        for s in set(slots):
            bins = min(bins, sum(n for _, n in queues[s]) // slots.count(s))
        while bins > 0:  # actual documents: runs of sequences with the same lengths
            take: dict[int, int] = defaultdict(int)
            lengths, run = [], bins
            for s in slots:
                skip = 0
                while queues[s][skip][1] <= 0:
                    skip += 1
                lengths.append(queues[s][skip][0])
                take[s, skip] += 1
            run = min([bins] + [queues[s][i][1] // m for (s, i), m in take.items()])
            if run == 0:  # a slot's run ends inside one sequence: fill it document by document
                run, lengths = 1, []
                for s in slots:
                    q = next(q for q in queues[s] if q[1] > 0)
                    q[1] -= 1
                    lengths.append(q[0])
            else:
                for (s, i), m in take.items():
                    queues[s][i][1] -= m * run
            for s in set(slots):
                queues[s] = [q for q in queues[s] if q[1] > 0] or [[0, 0]]
            offset = 0
            for s in lengths:
                put(s, run, opened, 1, offset)
                left[s] -= run
                offset += s
            gaps[capacity - offset].append((opened, run))
            opened, bins = opened + run, bins - run
    free = sorted(g for g in gaps if g)
    for s in sorted(left, reverse=True):
        m = left[s]
        while m:
            i = int(np.searchsorted(free, s))
            if i < len(free):
                gap = free[i]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    free.pop(i)
            else:
                gap, first, n = capacity, opened, -(-m // (capacity // s))
                opened += n
            per = gap // s
            full = min(n, m // per)
            for count, each in ((full, per), (1 if full < n and m > full * per else 0, m - full * per)):
                if count:
                    put(s, count * each, first, each, capacity - gap)
                    m -= count * each
                    rest = gap - each * s
                    if rest:
                        if not gaps[rest]:
                            free.insert(int(np.searchsorted(free, rest)), rest)
                        gaps[rest].append((first, count))
                    first, n = first + count, n - count
            if n:
                if not gaps[gap]:
                    free.insert(int(np.searchsorted(free, gap)), gap)
                gaps[gap].append((first, n))
    return intervals, opened


def _placed(ranked: DataFrame, intervals) -> DataFrame:
    by_length: dict[int, np.ndarray] = {}
    for length in {x[0] for x in intervals}:
        by_length[length] = np.array(sorted(x[1:] for x in intervals if x[0] == length), np.int64)
    table = ranked.sparkSession.sparkContext.broadcast(by_length)  # bounded by the capacity, see plan()
    schema = ranked.select("row").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                at, t = np.flatnonzero(length == s), table.value[s]
                place = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
                k = rank[at] - place[:, 0]
                seq[at], off[at] = place[:, 2] + k // place[:, 3], place[:, 4] + k % place[:, 3] * s
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(seq), pa.array(off)], names=["row", "sequence_id", "offset"])

    return ranked.select("row", "length", "_rank").mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``items`` (a column ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Items must be a stored table (it is read twice), without map columns. Lengths of null, under 1 or over
    ``capacity`` raise an error. Repeated rows are items of their own; an empty table gives an empty result; columns
    named like the results are replaced.
    """
    items = items.drop("sequence_id", "offset")
    counts = {r["length"]: r["count"] for r in items.groupBy("length").count().limit(capacity + 1).collect()}
    if any(s is None or not 1 <= s <= capacity for s in counts):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    intervals, _ = plan(counts, capacity, groups)
    salts = F.array(*[F.lit(-(-counts.get(s, 1) // RANKED)) for s in range(capacity + 1)])
    salted = items.select(F.struct("*").alias("row"), F.col("length").cast("bigint").alias("length")).withColumn(
        "_salt", F.pmod(F.xxhash64("row"), F.get(salts, F.col("length").cast("int"))))
    before = salted.groupBy("length", "_salt").count().withColumn("_before", F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("row")) - 1)
    ranked = ranked.join(before, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    return _placed(ranked, intervals).select("row.*", "sequence_id", "offset")


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack the pieces: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A null or empty text is the end id alone; a text of any length is tokenised whole by one task and cut. Repeated rows are
    packed as often; null doc_ids stay null; other columns are ignored.
    """
    cut = saved(pieces(docs, path or tokens.default_path(), capacity, keep_ids=keep_ids), "pieces")
    return pack(cut, capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents with their sequences.

    Null and empty texts are the end id alone, repeated rows are packed as often, null ids stay null, ties of length are
    placed by the row; an empty table gives an empty result, other columns are left out.
    """
    return best_fit_packing(docs)
